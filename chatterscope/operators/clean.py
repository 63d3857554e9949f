"""From raw posts to clean, dated, unique posts."""

from pyspark.sql import functions as F

from chatterscope.functions.text import collapse_ws
from chatterscope.functions.times import date_parts, event_date, event_ts


def filter_year(df, year=None):
    """Posts of one calendar year (UTC), as a range on the stored column so that scans can skip."""
    if year is None:
        return df
    year = int(year)
    start = F.expr(f"unix_date(make_date({year}, 1, 1)) * 86400L")
    end = F.expr(f"unix_date(make_date({year + 1}, 1, 1)) * 86400L")
    return df.where((F.col("created_utc") >= start) & (F.col("created_utc") < end))


def clean_posts(df):
    """Collapse white space and derive event_ts, event_date, year, month and day."""
    df = df.withColumn("text", collapse_ws("text"))
    df = df.withColumn("event_ts", event_ts("created_utc"))
    return date_parts(df.withColumn("event_date", event_date("event_ts")))
