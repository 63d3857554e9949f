"""What several operators of this subpackage share: scratch tables, size-checked joins, word arrays."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatterscope.session import BATCH_ROWS, bounded_batches, scratch_path  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A side is copied to every executor only if it was counted below this many rows of a few dozen bytes.
COPY_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage, so that a lost executor costs its tasks only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def copied_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """With a broadcast hint if the side was counted below COPY_ROWS; else Spark joins by shuffling."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= COPY_ROWS else df.hint("merge")


def ascii_lower(text):
    """A-Z to a-z and nothing else; `lower` does the same, but faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def split_words(text, separators):
    """The non-empty pieces between runs of separators; a null text has none."""
    return F.coalesce(F.array_remove(F.split(text, separators), ""), F.array().cast("array<string>"))


def text_mark(text="text"):
    """Tells rows of one doc_id with different texts apart; null has a mark of its own."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def without(docs: DataFrame, ids: DataFrame, rows: int | None = None) -> DataFrame:
    """docs without the rows whose (doc_id, text mark) is listed in ids(doc_id, mark); all columns stay."""
    listed = copied_if_small(ids.select("doc_id", "mark"), rows).alias("listed")
    here = docs.alias("here")
    same = F.col("here.doc_id").eqNullSafe(F.col("listed.doc_id")) & (
        text_mark("here.text") == F.col("listed.mark")
    )
    return here.join(listed, same, "left_anti")
