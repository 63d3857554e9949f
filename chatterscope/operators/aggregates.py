"""Daily aggregates per brand."""

from pyspark.sql import functions as F


def exact_mean(c):
    """Mean of scores that does not depend on the order in which tasks add them up.

    Digits after the twelfth are cut. Where a score does not fit (NaN, infinite, 1e8 or more), it is the plain mean.
    """
    fixed = F.col(c).try_cast("decimal(20,12)")
    return F.when(F.count(fixed) == F.count(c), F.avg(fixed).cast("double")).otherwise(F.avg(F.col(c).cast("double")))


def daily_aggregate(scored):
    """Mentions, sentiment and events per brand and day.

    All state is of fixed width, so tasks aggregate by hashing before anything is shuffled.
    """
    return scored.groupBy("brand", "event_date").agg(
        F.count(F.lit(1)).alias("mentions"),
        exact_mean("compound").alias("avg_compound"),
        F.count_if(F.col("sentiment") == "positive").alias("positive"),
        F.count_if(F.col("sentiment") == "negative").alias("negative"),
        F.count_if(F.col("sentiment") == "neutral").alias("neutral"),
        F.count_if(F.col("event_hit")).alias("event_hits"),
        F.count_if(F.size("event_tags") > 0).alias("event_posts"),
        F.max("score").alias("max_score"),
    )


def with_month(daily):
    """Add the partition columns of the daily table."""
    return daily.withColumns(
        {
            "year": F.date_format("event_date", "yyyy"),
            "month": F.date_format("event_date", "MM"),
        }
    )
