"""Column functions on time."""

from pyspark.sql import functions as F

from chatterscope.functions.text import _col

# Fixed value: the spelling of a plain number. Casts alone would also take `1d` or `Infinity`.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_or_null(c):
    """A string as double if it spells a finite number, else null."""
    c = _col(c)
    return F.when(F.rlike(c, F.lit(_NUMBER)), F.trim(c).try_cast("double"))


def event_ts(created_utc):
    return F.timestamp_seconds(_col(created_utc))


def event_date(ts):
    """The date of a timestamp in UTC, whatever the zone of the session."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(ts)) / 86400).cast("int"))


def date_parts(df, date="event_date"):
    """Zero-padded strings year, month and day of a date column."""
    return df.withColumns(
        {
            "year": F.date_format(date, "yyyy"),
            "month": F.date_format(date, "MM"),
            "day": F.date_format(date, "dd"),
        }
    )


def seconds_of_number(n):
    """Numbers below 1e12 are seconds, larger ones are milliseconds."""
    return F.when(n < 1e12, n).otherwise(F.floor(n / 1000).cast("double"))


def to_epoch_seconds(c, dtype="string"):
    """Timestamps in mixed notations as epoch seconds (double); null if they cannot be read.

    `dtype` is the type of the column, as in `df.dtypes`.
    """
    c = _col(c)
    if dtype in ("timestamp", "date"):
        return F.unix_seconds(c.cast("timestamp")).cast("double")
    if dtype == "timestamp_ntz":
        return F.floor(F.unix_micros(c.cast("timestamp")) / 1_000_000).cast("double")
    if dtype != "string":
        return seconds_of_number(c.cast("double"))
    parsed = F.unix_seconds(F.try_to_timestamp(c)).cast("double")
    return F.coalesce(seconds_of_number(number_or_null(c)), parsed)
