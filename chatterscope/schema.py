"""Declared schemas. Reads never infer: every scan names its columns and types."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


POST_SCHEMA = _struct(
    ("id", StringType()),
    ("type", StringType()),
    ("subreddit", StringType()),
    ("author", StringType()),
    ("created_utc", LongType()),
    ("text", StringType()),
    ("url", StringType()),
    ("score", IntegerType()),
    ("num_comments", IntegerType()),
    ("parent_id", StringType()),
    ("brand", StringType()),
    ("fetched_at", LongType()),
    ("permalink", StringType()),
)

_AUTHOR = _struct(("name", StringType()))

SUBMISSION_SCHEMA = _struct(
    ("id", StringType()),
    ("subreddit", StringType()),
    ("author", _AUTHOR),
    ("created_utc", LongType()),
    ("title", StringType()),
    ("selftext", StringType()),
    ("permalink", StringType()),
    ("score", LongType()),
    ("num_comments", LongType()),
)

COMMENT_SCHEMA = _struct(
    ("id", StringType()),
    ("subreddit", StringType()),
    ("author", _AUTHOR),
    ("created_utc", LongType()),
    ("body", StringType()),
    ("permalink", StringType()),
    ("score", LongType()),
    ("parent_id", StringType()),
)

POSTS_PARTITIONS = ("year", "month", "day", "brand")
DAILY_PARTITIONS = ("year", "month", "brand")
TOPS_PARTITIONS = ("year", "month", "brand")

# Partition columns are declared as strings: left to inference, month=01 comes back as the int 1.
SCORED_SCHEMA = _struct(
    ("id", StringType()),
    ("type", StringType()),
    ("subreddit", StringType()),
    ("author", StringType()),
    ("created_utc", LongType()),
    ("text", StringType()),
    ("url", StringType()),
    ("score", IntegerType()),
    ("num_comments", IntegerType()),
    ("parent_id", StringType()),
    ("fetched_at", LongType()),
    ("permalink", StringType()),
    ("event_ts", TimestampType()),
    ("event_date", DateType()),
    ("event_tags", ArrayType(StringType())),
    ("compound", DoubleType()),
    ("sentiment", StringType()),
    ("event_hit", BooleanType()),
    ("year", StringType()),
    ("month", StringType()),
    ("day", StringType()),
    ("brand", StringType()),
)

DAILY_SCHEMA = _struct(
    ("event_date", DateType()),
    ("mentions", LongType()),
    ("avg_compound", DoubleType()),
    ("positive", LongType()),
    ("negative", LongType()),
    ("neutral", LongType()),
    ("event_hits", LongType()),
    ("event_posts", LongType()),
    ("max_score", IntegerType()),
    ("year", StringType()),
    ("month", StringType()),
    ("brand", StringType()),
)

TOPS_COLUMNS = (
    "brand", "year", "month", "id", "type", "subreddit", "author", "event_ts", "score",
    "num_comments", "url", "permalink", "compound", "sentiment", "event_tags", "text",
)

TOPS_SCHEMA = StructType(
    [SCORED_SCHEMA[c] for c in TOPS_COLUMNS if c not in TOPS_PARTITIONS]
    + [SCORED_SCHEMA[c] for c in TOPS_PARTITIONS]
)

DISPLAY_COLUMNS = (
    "score", "event_ts", "subreddit", "compound", "sentiment", "event_tags", "link", "text",
)

LIVE_POINT_SCHEMA = _struct(
    ("ts", TimestampType()),
    ("mentions", LongType()),
    ("avg_compound", DoubleType()),
    ("top_permalink", StringType()),
    ("top_text", StringType()),
    ("provider", StringType()),
)

LEXICON_SCHEMA = _struct(("token", StringType()), ("valence", DoubleType()))
