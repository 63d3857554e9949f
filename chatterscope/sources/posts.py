"""Reading newline-delimited JSON posts, in batch and as a stream."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from chatterscope.schema import POST_SCHEMA

_BROKEN = "_broken"


def read_posts(spark, path):
    """Posts with the declared schema; unknown fields are ignored, broken fields become null."""
    return spark.read.schema(POST_SCHEMA).json(path)


def read_posts_stream(spark, path, max_files=None, schema=POST_SCHEMA):
    """New files of a folder as a stream; `max_files` bounds what one micro-batch takes in."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_posts_lenient(spark, path):
    """Posts from the `*.json` files of a folder; unreadable files and lines are skipped, a missing folder is empty.

    Whether a line is skipped does not depend on the columns that are read: every line is parsed whole.
    """
    reader = spark.read.option("pathGlobFilter", "*.json").option("ignoreCorruptFiles", "true")
    try:
        lines = reader.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POST_SCHEMA)
    whole = StructType([*POST_SCHEMA.fields]).add(_BROKEN, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    posts = lines.where(F.trim("value") != "").select(F.from_json("value", whole, options).alias("post"))
    return posts.where(f"post is not null and post.{_BROKEN} is null").select("post.*").drop(_BROKEN)
