"""Checks of sources, raw-record mapping and NDJSON sinks in batch."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks import views as V
from checks.registry import query
from checks.text import SUBMISSION_TEXT
from chatterscope.operators import ingest
from chatterscope.schema import POST_SCHEMA
from chatterscope.session import scratch_path
from chatterscope.sinks.files import write_backfill
from chatterscope.sources.posts import read_posts, read_posts_lenient

POST_COLUMNS = """id, type, subreddit, author, created_utc, md5(text) AS digest, url, score,
  num_comments, parent_id, fetched_at, permalink"""


def shown(posts):
    return posts.withColumn("digest", F.md5("text")).drop("text", "brand")


@query("s1_read_posts", O.select(O.POSTS, f"SELECT {POST_COLUMNS} FROM posts"))
def scan_posts(spark, sf):
    path = scratch_path(spark, "ndjson")
    V.posts(spark, sf).withColumn("extra", F.lit("ignored")).write.json(path)
    return shown(read_posts(spark, path))


@query("s3_read_posts_lenient", O.select(O.POSTS, f"SELECT {POST_COLUMNS} FROM posts"))
def scan_lenient(spark, sf):
    """Every post once as it should be, once with a broken time and once in a file of another name."""
    path = scratch_path(spark, "lenient")
    posts = V.posts(spark, sf)
    posts.write.json(path)
    posts.withColumn("created_utc", F.lit("soon")).write.mode("append").json(path)
    posts.select(F.to_json(F.struct(*POST_SCHEMA.names))).write.mode("append").text(path)
    return shown(read_posts_lenient(spark, path))


_SUBMISSION = f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'submission' AS type, source AS subreddit,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'u' || CAST(doc_id % 25 AS VARCHAR) END AS author,
  CASE WHEN doc_id % 11 = 0 THEN {V.NOW} ELSE 1704067200 + (doc_id * 79193) % 5184000 END AS created_utc,
  md5({SUBMISSION_TEXT}) AS digest,
  'https://www.reddit.com/p/' || CAST(doc_id AS VARCHAR) AS url,
  CAST(CASE WHEN doc_id % 17 = 0 THEN 0 ELSE (doc_id * 37) % 31 END AS INT) AS score,
  CAST(CASE WHEN doc_id % 13 = 0 THEN 0 ELSE (doc_id * 13) % 50 END AS INT) AS num_comments,
  CAST(NULL AS VARCHAR) AS parent_id, CAST({V.NOW} AS BIGINT) AS fetched_at,
  'https://www.reddit.com/p/' || CAST(doc_id AS VARCHAR) AS permalink FROM documents"""

_COMMENT = f"""SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, 'comment' AS type,
  role AS subreddit, CASE WHEN turn % 3 = 0 THEN '' ELSE role END AS author,
  1704067200 + conv_id * 60 + turn AS created_utc,
  md5(CASE WHEN turn % 5 = 4 THEN '' ELSE text END) AS digest,
  'https://www.reddit.com/c/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS url,
  CAST(CASE WHEN conv_id % 4 = 0 THEN 0 ELSE (conv_id * 7 + turn) % 19 END AS INT) AS score,
  CAST(NULL AS INT) AS num_comments, 't3_' || CAST(conv_id AS VARCHAR) AS parent_id,
  CAST({V.NOW} AS BIGINT) AS fetched_at,
  'https://www.reddit.com/c/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS permalink
  FROM conversations"""


@query("s8_normalize_submissions", _SUBMISSION)
def normalize_submissions(spark, sf):
    return shown(ingest.normalize_submissions(V.submissions(spark, sf), V.NOW))


@query("s9_normalize_comments", _COMMENT)
def normalize_comments(spark, sf):
    return shown(ingest.normalize_comments(V.comments(spark, sf), V.NOW))


# All posts, of which every tenth is there in two versions: the one fetched last counts.
_LAST = """last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC) AS version FROM posts)
  WHERE version = 1 AND created_utc >= 1704067200 AND created_utc < 1708000000),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC NULLS LAST, id) AS place
  FROM last WHERE subreddit IN ('src1', 'src2', 'src3', 'src12'))"""


def top(spark, sf, n, *more):
    return ingest.backfill_top(V.posts(spark, sf), ["src1", "Src2", "src3", "src12", *more], n, 1704067200, 1708000000)


@query("s10_backfill_top", O.select(O.POSTS + "," + _LAST, "SELECT subreddit, id, score FROM ranked WHERE place <= 10"))
def backfill_top(spark, sf):
    return top(spark, sf, 10).select("subreddit", "id", "score")


@query(
    "l6_limit_per_group",
    O.select(O.POSTS + "," + _LAST, "SELECT subreddit, count(*) AS kept, min(score) AS lowest FROM ranked WHERE place <= 2000 GROUP BY subreddit"),
)
def limit_per_group(spark, sf):
    """More rows per group than Spark cuts inside its map tasks."""
    return top(spark, sf, 2000).groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("kept"), F.min("score").alias("lowest")
    )


@query("k6_write_backfill", O.select(O.POSTS + "," + _LAST, f"SELECT {POST_COLUMNS} FROM ranked WHERE place <= 10"))
def backfill_sink(spark, sf):
    path = write_backfill(top(spark, sf, 10), scratch_path(spark, "backfill"))
    return shown(read_posts(spark, path))


@query(
    "s10_backfill_versions",
    O.select(O.POSTS + "," + _LAST, "SELECT subreddit, id, score, fetched_at FROM ranked WHERE place <= 10"),
)
def backfill_versions(spark, sf):
    return top(spark, sf, 10).select("subreddit", "id", "score", "fetched_at")


@query(
    "s10_backfill_all_and_some",
    O.select(O.POSTS + "," + _LAST, """SELECT subreddit, id, score, fetched_at FROM ranked WHERE place <= 10 UNION
    SELECT subreddit, id, score, fetched_at FROM (
      SELECT * FROM last ORDER BY score DESC NULLS LAST, id LIMIT 10)"""),
)
def backfill_all_and_some(spark, sf):
    return top(spark, sf, 10, " ALL").select("subreddit", "id", "score", "fetched_at")


@query(
    "l6_limit_per_group_versions",
    O.select(O.POSTS + "," + _LAST, """SELECT subreddit, count(*) AS kept, min(score) AS lowest,
    CAST(sum(fetched_at) AS BIGINT) AS fetched FROM ranked WHERE place <= 2000 GROUP BY subreddit"""),
)
def limit_per_group_versions(spark, sf):
    return top(spark, sf, 2000).groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("kept"), F.min("score").alias("lowest"), F.sum("fetched_at").alias("fetched")
    )


@query("k6_write_backfill_versions", O.select(O.POSTS + "," + _LAST, f"SELECT {POST_COLUMNS} FROM ranked WHERE place <= 10"))
def backfill_sink_versions(spark, sf):
    path = write_backfill(top(spark, sf, 10), scratch_path(spark, "backfill"))
    return shown(read_posts(spark, path))


@query(
    "u1_union_frames",
    """SELECT type, count(*) AS n, count(score) AS scores, count(body) AS bodies FROM (
      SELECT 'doc' AS type, doc_id AS score, NULL AS body FROM documents
      UNION ALL SELECT 'turn', NULL, text FROM conversations) GROUP BY type""",
)
def union_frames(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.lit("doc").alias("type"), F.col("doc_id").alias("score"))
    turns = V.table(spark, sf, "conversations").select(F.lit("turn").alias("type"), F.col("text").alias("body"))
    return ingest.union_frames(docs, turns).groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("scores"), F.count("body").alias("bodies")
    )


@query(
    "u2_union_feeds",
    f"""SELECT type, count(*) AS n, CAST(sum(score) AS BIGINT) AS score FROM ({_SUBMISSION}
    UNION ALL {_COMMENT}) GROUP BY type""",
)
def union_feeds(spark, sf):
    both = ingest.union_feeds(
        ingest.normalize_submissions(V.submissions(spark, sf), V.NOW),
        ingest.normalize_comments(V.comments(spark, sf), V.NOW),
    )
    return both.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
