"""Writing partitioned Parquet tables."""

from chatterscope.operators.aggregates import with_month
from chatterscope.schema import DAILY_PARTITIONS, POSTS_PARTITIONS, TOPS_PARTITIONS

POSTS_TABLE = "posts"
DAILY_TABLE = "aggregates_daily"
TOPS_TABLE = "top_posts_monthly"


def dealt(df, partitions):
    """Rows grouped by folder like a repartition, but adaptive execution may split a folder that holds a large share of all
    rows over several writers."""
    return df.hint("rebalance", *partitions)


def _write(df, path, partitions):
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return path


def write_posts(df, base, grouped=False):
    """`grouped` rows come from few folders in each task already, and are written where they are."""
    df = df if grouped else dealt(df, POSTS_PARTITIONS)
    return _write(df, f"{base}/{POSTS_TABLE}", POSTS_PARTITIONS)


def write_daily(df, base):
    return _write(dealt(with_month(df), DAILY_PARTITIONS), f"{base}/{DAILY_TABLE}", DAILY_PARTITIONS)


def write_tops(df, base, grouped=False):
    df = df if grouped else dealt(df, TOPS_PARTITIONS)
    return _write(df, f"{base}/{TOPS_TABLE}", TOPS_PARTITIONS)


def refresh(spark, path):
    """Forget cached file lists and data of a path, so that new files are seen."""
    spark.catalog.refreshByPath(path)
