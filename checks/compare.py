"""Run the queries next to their SQL: python -m checks.compare [folder] [name prefix ...]"""

import sys
import time

import duckdb

from checks import registry
from chatterscope.session import get_spark

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def compare(spark, con, sf, name, fn, sql):
    """Difference between both results as text, or an empty string."""
    frame = fn(spark, sf)
    got = normal([tuple(r) for r in frame.collect()], frame.columns)
    if sql is None:
        return ""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}"
    want = normal(result.fetchall(), names)
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    return next((f"{g} vs {w}" for g, w in zip(got, want) if g != w), "")


def main(sf="/root/testdata/sf0.01", *prefixes):
    queries, oracle = registry.load()
    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf, name, fn, oracle.get(name))
        except Exception as err:
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.1f}s {problem[:900]}", flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
