"""Slices and lists behind a dashboard."""

from pyspark.sql import functions as F

from chatterscope.functions.text import markdown_link
from chatterscope.schema import DISPLAY_COLUMNS, TOPS_COLUMNS


def select_tops(df):
    return df.select(*TOPS_COLUMNS)


def slice_daily(daily, brand, year=None):
    if year:
        daily = daily.where(F.col("year") == year)
    return daily.where(F.col("brand") == brand)


def slice_tops(tops, brand, year, month):
    return tops.where(
        (F.col("brand") == brand) & (F.col("year") == year) & (F.col("month") == month)
    )


def as_series(daily):
    """Daily rows as a time series with a timestamp `date`."""
    return daily.withColumnRenamed("event_date", "date").withColumn(
        "date", F.col("date").cast("timestamp")
    )


def order_series(series, date="date"):
    return series.orderBy(F.col(date).asc())


def order_tops(tops):
    return tops.orderBy(F.col("score").desc_nulls_last())


def select_display(tops):
    """The columns shown for monthly top posts, with a clickable link."""
    return tops.withColumn("link", markdown_link("permalink")).select(*DISPLAY_COLUMNS)


def list_brands(daily):
    return daily.select("brand").where(F.col("brand").isNotNull()).distinct().orderBy("brand")


def list_years(daily):
    return daily.select("year").where(F.col("year").isNotNull()).distinct().orderBy("year")


def latest_year(daily):
    return daily.agg(F.max("year").alias("year"))


def list_months(tops, brand):
    """Months with top posts of a brand, and whether it is the latest one."""
    months = tops.where(F.col("brand") == brand).select("year", "month").distinct()
    latest = months.agg(F.max(F.struct("year", "month")))
    return months.withColumn(
        "is_latest", F.struct("year", "month") == latest.scalar()
    ).orderBy("year", "month")
