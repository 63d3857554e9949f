"""Reading the tables that the batch job writes."""

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chatterscope.schema import DAILY_SCHEMA, LEXICON_SCHEMA, SCORED_SCHEMA, TOPS_SCHEMA
from chatterscope.sinks.tables import DAILY_TABLE, POSTS_TABLE, TOPS_TABLE


def _read_or_empty(spark, path, schema):
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_posts_table(spark, base):
    return _read_or_empty(spark, f"{base}/{POSTS_TABLE}", SCORED_SCHEMA)


def read_daily(spark, base):
    """Daily aggregates; empty if the job has not run yet."""
    return _read_or_empty(spark, f"{base}/{DAILY_TABLE}", DAILY_SCHEMA)


def read_tops(spark, base):
    """Monthly top posts; empty if the job has not run yet."""
    return _read_or_empty(spark, f"{base}/{TOPS_TABLE}", TOPS_SCHEMA)


def read_posts_for(spark, base, day, brand):
    """Posts of one day and brand; only the folder of that day and brand is scanned."""
    day = datetime.date.fromisoformat(str(day)[:10])
    return read_posts_table(spark, base).where(
        (F.col("year") == f"{day:%Y}")
        & (F.col("month") == f"{day:%m}")
        & (F.col("day") == f"{day:%d}")
        & (F.col("brand") == brand)
    )


def read_lexicon(spark, path):
    """A tab-separated lexicon: token, mean valence, and columns that are ignored."""
    lines = spark.read.option("sep", "\t").option("quote", "").schema(LEXICON_SCHEMA).csv(path)
    return lines.where(F.col("token").isNotNull() & F.col("valence").isNotNull())
