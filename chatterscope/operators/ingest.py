"""From raw submissions and comments to posts."""

from functools import reduce

from pyspark.sql import functions as F

from chatterscope.functions.text import submission_text
from chatterscope.operators.ranking import chosen, fetched, limit_per_group, marked
from chatterscope.schema import POST_SCHEMA

# Fixed value: the site that relative links of raw records belong to.
SITE = "https://www.reddit.com"


def stamp_fetched(df, now=None):
    """Note when rows were fetched; rows without a creation time get the same time."""
    stamp = F.unix_timestamp(F.current_timestamp()) if now is None else F.lit(int(now))
    df = df.withColumn("fetched_at", stamp.cast("long"))
    return df.withColumn("created_utc", F.coalesce("created_utc", "fetched_at").cast("long"))


def ingest_defaults(df):
    """Missing authors become empty, missing scores and comment counts 0."""
    fills = {"author": F.coalesce("author", F.lit("")), "score": F.coalesce("score", F.lit(0))}
    if "num_comments" in df.columns:
        fills["num_comments"] = F.coalesce("num_comments", F.lit(0))
    return df.withColumns(fills)


def _as_posts(df):
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POST_SCHEMA])


def _flat(df):
    return df.withColumn("author", F.col("author.name"))


def _links(df, prefix):
    link = F.concat(F.lit(prefix), F.col("permalink"))
    return df.withColumns({"url": link, "permalink": link})


def normalize_submissions(df, now=None, prefix=SITE):
    """Raw submissions as posts; keeps a brand found earlier."""
    df = stamp_fetched(ingest_defaults(_flat(df)), now)
    brand = F.col("brand") if "brand" in df.columns else F.lit(None)
    return _as_posts(
        _links(df, prefix).withColumns(
            {
                "type": F.lit("submission"),
                "text": submission_text("title", "selftext"),
                "parent_id": F.lit(None),
                "brand": brand,
            }
        )
    )


def normalize_comments(df, now=None, prefix=SITE):
    """Raw comments as posts: no comment count, but a parent."""
    df = stamp_fetched(ingest_defaults(_flat(df)), now)
    brand = F.col("brand") if "brand" in df.columns else F.lit(None)
    return _as_posts(
        _links(df, prefix).withColumns(
            {
                "type": F.lit("comment"),
                "text": F.coalesce("body", F.lit("")),
                "num_comments": F.lit(None),
                "brand": brand,
            }
        )
    )


def _last_versions(rows):
    """One row per id, the one fetched last; rows without an id stay. rows are `marked`."""
    ranks = {"fetched_at": "desc", "score": "desc", "created_utc": "desc", "permalink": "asc", "_m1": "asc", "_m2": "asc"}
    order = [getattr(F.col(c), f"{way}_nulls_last")() for c, way in ranks.items() if c in rows.columns]
    # A row without an id is a group of its own.
    rows = rows.withColumn("_nameless", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    return limit_per_group(rows, ["id", "_nameless"], order, 1).drop("_nameless")


def backfill_top(df, subs, n=200, since=None, until=None):
    """The `n` best submissions per community in a time range, as posts without a brand.

    The community `all` stands for every community taken together; named ones next to it keep their own share, and a
    post that is in both is there once. Names are compared without case and outer spaces. Of the versions of an id in
    the time range, the one fetched last counts, then the one of the higher score; rows without an id are all kept.

    Rows are ranked without their texts, which are fetched for the few that are left.
    """
    if since is not None:
        df = df.where(F.col("created_utc") >= since)
    if until is not None:
        df = df.where(F.col("created_utc") < until)
    names = list(dict.fromkeys(s.strip().lower() for s in subs))
    rows = marked(df)
    last = _last_versions(rows).withColumn("_community", F.lower(F.trim("subreddit")))
    last = last.select("id", "score", "_community", "_m1", "_m2")
    order = [F.col("score").desc_nulls_last(), F.col("id").asc(), F.col("_m1").asc(), F.col("_m2").asc()]
    listed = limit_per_group(last.where(F.col("_community").isin(names)), ["_community"], order, n)
    keys = chosen(listed)
    if "all" in names:
        keys = keys.unionByName(chosen(last.orderBy(*order).limit(n)))
        keys = keys.groupBy("_m1", "_m2").agg(F.max("_times").alias("_times"))
    found = fetched(rows, keys, most=n * (len(names) + 1))
    return found.withColumn("brand", F.lit(None).cast("string"))


def union_frames(*frames):
    """All rows of frames whose columns differ; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_feeds(submissions, comments):
    """Both feeds as one, on batches and on streams."""
    return submissions.unionByName(comments)
