"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks import registry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLE.get(name)) == ""


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 110 and "avg_compound" in frame.columns


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
