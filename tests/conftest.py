import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatterscope.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def posts(spark):
    """Build posts from dicts; fields that are not named are null."""
    from chatterscope.schema import POST_SCHEMA

    def build(*rows):
        full = [tuple(row.get(f) for f in POST_SCHEMA.names) for row in rows]
        return spark.createDataFrame(full, POST_SCHEMA)

    return build


@pytest.fixture
def column(spark):
    """Apply a function Column -> Column to values and return the results in order."""
    from pyspark.sql import functions as F

    def apply(fn, values, dtype="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
        result = rows.select("i", fn(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(result, key=lambda r: r["i"])]

    return apply
