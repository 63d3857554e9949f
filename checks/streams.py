"""Checks of streaming queries: each runs over files of the given tables until they are used up."""

import itertools
import time

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType, TimestampType

from checks import oracle as O
from checks import views as V
from checks.ingest import POST_COLUMNS, _COMMENT, _SUBMISSION, shown
from checks.registry import query
from chatterscope.functions.sentiment import sentiment_label
from chatterscope.functions.times import event_ts
from chatterscope.schema import COMMENT_SCHEMA, POST_SCHEMA, SUBMISSION_SCHEMA
from chatterscope.session import scratch_path
from chatterscope.sinks.files import start_ndjson_sink
from chatterscope.sources.posts import read_posts, read_posts_stream
from chatterscope.streaming.dedupe import dedupe_bounded, dedupe_stream
from chatterscope.streaming.ingest import start_ingest
from chatterscope.streaming.live import read_points, read_ticks, start_live
from chatterscope.streaming.windows import (
    latest_updates,
    score_stream,
    start_window_query,
    table_sink,
    windowed_sentiment,
)

_EVENT_SCHEMA = (
    StructType()
    .add("id", StringType())
    .add("event_ts", TimestampType())
    .add("brand", StringType())
    .add("compound", DoubleType())
)


def run(started):
    started.awaitTermination()
    return started


def posts_folder(spark, sf, name):
    path = scratch_path(spark, name)
    V.posts(spark, sf).write.option("ignoreNullFields", "false").json(path)
    return path


def updates(spark, sf, late=False):
    """Windows over three portions of events that arrive one after another, in three runs of the
    same query. With `late`, events of the first days follow once more, too late to count.
    """
    events = V.scored_events(spark, sf)
    source, out, checkpoint = (scratch_path(spark, n) for n in ("events", "updates", "checkpoint"))
    when = F.col("event_ts")
    portions = [
        events.where(when < "2024-01-11"),
        events.where((when >= "2024-01-11") & (when < "2024-01-21")),
        events.where(when >= "2024-01-21"),
    ]
    if late:
        portions.append(events.where(when < "2024-01-06"))
    for portion in portions:
        portion.write.mode("append").json(source)
        stream = read_posts_stream(spark, source, schema=_EVENT_SCHEMA)
        stream = stream.withColumn("sentiment", sentiment_label("compound"))
        run(
            start_window_query(
                windowed_sentiment(stream), table_sink(out), checkpoint, once=True
            )
        )
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*")


def windows(spark, sf, late=False):
    last = latest_updates(updates(spark, sf, late))
    return last.withColumn("avg_compound", F.round("avg_compound", 8))


_WINDOWS = f"""WITH e AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, event_type AS brand,
  round(least(1e0, value / 250e0 - 1e0), 4) AS compound FROM events),
s AS (SELECT *, {O.LABEL} AS sentiment FROM e)
SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, brand, sentiment,
  count(*) AS mentions, {O.MEAN} AS avg_compound FROM s GROUP BY ALL"""


@query("t1_t2_windowed_sentiment", _WINDOWS)
def windowed(spark, sf):
    return windows(spark, sf)


@query(
    "k4_t3_window_updates",
    f"""SELECT brand, CAST(sum(mentions) AS BIGINT) AS mentions, count(*) AS updates
    FROM ({_WINDOWS}) GROUP BY brand""",
)
def window_updates(spark, sf):
    """No window spans two portions, so update mode reports each of them once."""
    return updates(spark, sf).groupBy("brand").agg(
        F.sum("mentions").alias("mentions"), F.count(F.lit(1)).alias("updates")
    )


@query("t4_late_rows", _WINDOWS)
def late_rows(spark, sf):
    return windows(spark, sf, late=True)


@query("t2_windowed_batch", _WINDOWS)
def windowed_batch(spark, sf):
    scored = V.scored_events(spark, sf).withColumn("sentiment", sentiment_label("compound"))
    return windowed_sentiment(scored).withColumn("avg_compound", F.round("avg_compound", 8))


_POST_WINDOWS = f"""SELECT time_bucket(INTERVAL '1 minute', make_timestamp(created_utc * 1000000))
  AS window_start, brand, {O.LABEL} AS sentiment, count(*) AS mentions,
  {O.MEAN} AS avg_compound"""
_TEXTS = "texts AS (SELECT id, min(text) AS text FROM posts GROUP BY id)," + O.scores("texts")


def stream_job(spark, sf, cfg=None):
    stream = read_posts_stream(spark, posts_folder(spark, sf, "posts"))
    scored = score_stream(stream, V.LEXICON, V.RULES, cfg=cfg)
    out = scratch_path(spark, "updates")
    checkpoint = scratch_path(spark, "checkpoint")
    run(start_window_query(windowed_sentiment(scored), table_sink(out), checkpoint, once=True))
    last = latest_updates(spark.read.option("basePath", out).parquet(f"{out}/batch=*"))
    return last.withColumn("avg_compound", F.round("avg_compound", 8)).drop("window_end")


@query(
    "e2_stream_job",
    O.select(O.POSTS + "," + _TEXTS, _POST_WINDOWS + """ FROM posts p JOIN scores s ON p.id = s.id
    GROUP BY ALL"""),
)
def stream_of_posts(spark, sf):
    return stream_job(spark, sf)


@query(
    "e2_stream_job_tagged",
    O.select(O.POSTS + "," + _TEXTS, _POST_WINDOWS.replace("brand,", "b.brand,", 1) + """ FROM posts p
    JOIN scores s ON p.id = s.id, (VALUES ('src1'), ('src2'), ('gamma')) b(brand)
    WHERE (b.brand = 'src1' AND (contains(lower(text), 'oning') OR contains(lower(text), 'thble')
        OR subreddit IN ('src1', 'src12')))
      OR (b.brand = 'src2' AND (contains(lower(text), 'mentre') OR contains(lower(text), 'license')
        OR subreddit = 'src2'))
      OR (b.brand = 'gamma' AND contains(lower(text), 'ingre')) GROUP BY ALL"""),
)
def tagged_stream_of_posts(spark, sf):
    return stream_job(spark, sf, V.CONFIG)


@query("s2_read_posts_stream", O.select(O.POSTS, f"SELECT {POST_COLUMNS} FROM posts"))
def posts_stream(spark, sf):
    stream = read_posts_stream(spark, posts_folder(spark, sf, "streamed"))
    out = scratch_path(spark, "copied")
    run(start_ndjson_sink(stream, out, scratch_path(spark, "checkpoint"), max_batch=0, once=True))
    return shown(read_posts(spark, out))


@query(
    "k5_ndjson_sink",
    O.select(O.POSTS, "SELECT count(*) AS posts, true AS small FROM posts"),
)
def ndjson_sink(spark, sf):
    """All posts arrive, in files of at most 200 records."""
    stream = read_posts_stream(spark, posts_folder(spark, sf, "fed"))
    out = scratch_path(spark, "ndjson")
    run(start_ndjson_sink(stream, out, scratch_path(spark, "checkpoint"), once=True))
    files = read_posts(spark, out).groupBy(F.input_file_name()).count()
    return files.agg(
        F.sum("count").alias("posts"), (F.max("count") <= 200).alias("small")
    )


@query("t5_dedupe_stream", O.select(O.POSTS, "SELECT DISTINCT type, id, created_utc FROM posts"))
def dedupe(spark, sf):
    stream = read_posts_stream(spark, posts_folder(spark, sf, "repeated"))
    unique = dedupe_stream(stream.withColumn("event_ts", event_ts("created_utc")), "60 days")
    out = scratch_path(spark, "unique")
    columns = unique.select(*POST_SCHEMA.names)
    run(start_ndjson_sink(columns, out, scratch_path(spark, "checkpoint"), once=True))
    return read_posts(spark, out).select("type", "id", "created_utc")


@query("t5_dedupe_stream_spread", O.select(O.POSTS, "SELECT DISTINCT type, id, created_utc FROM posts"))
def dedupe_spread(spark, sf):
    stream = read_posts_stream(spark, posts_folder(spark, sf, "repeated"))
    dated = stream.withColumn("event_ts", event_ts("created_utc"))
    unique = dedupe_stream(dated, "60 days", spread=True)
    out = scratch_path(spark, "unique")
    columns = unique.select(*POST_SCHEMA.names)
    run(start_ndjson_sink(columns, out, scratch_path(spark, "checkpoint"), once=True))
    return read_posts(spark, out).select("type", "id", "created_utc")


@query(
    "t5_dedupe_bounded",
    O.select(O.POSTS, "SELECT type, count(DISTINCT id) AS ids, true AS forgotten FROM posts GROUP BY type"),
)
def dedupe_by_number(spark, sf):
    """All posts twice, in two runs on one checkpoint, with eight shares of one id each: by the second run all ids but at most
    eight are forgotten and come again, each once.
    """
    source, out, checkpoint = (scratch_path(spark, n) for n in ("bounded", "unique", "checkpoint"))
    posts = V.posts(spark, sf).select(*POST_SCHEMA.names)
    for _ in range(2):
        posts.write.mode("append").option("compression", "zstd").parquet(source)
        stream = spark.readStream.schema(POST_SCHEMA).parquet(source)
        unique = dedupe_bounded(stream, bound=8, shards=8)
        sink = table_sink(out, compression="zstd")
        writer = unique.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
        run(writer.trigger(availableNow=True).start())
    found = spark.read.parquet(out).groupBy("type", "id").agg(F.count(F.lit(1)).alias("times"))
    once, most = F.count_if(F.col("times") == 1), F.max("times")
    return found.groupBy("type").agg(F.count(F.lit(1)).alias("ids"), ((once <= 8) & (most == 2)).alias("forgotten"))


@query(
    "t5_late_posts",
    O.select(O.POSTS, """SELECT DISTINCT type, id, created_utc FROM posts
    UNION ALL SELECT 'comment', 'ahead', 4102444800"""),
)
def late_posts(spark, sf):
    """The newest posts first, with one dated years ahead, then older ones days apart and the first ones again, in
    runs of one query with the default delay.
    """
    posts = V.posts(spark, sf)
    when = F.col("created_utc")
    newest = posts.where(when >= 1704067200 + 40 * 86400)
    ahead = spark.createDataFrame(
        [tuple({"id": "ahead", "type": "comment", "created_utc": 4102444800}.get(c) for c in POST_SCHEMA.names)], POST_SCHEMA
    )
    middle = posts.where((when >= 1704067200 + 10 * 86400) & (when < 1704067200 + 40 * 86400))
    oldest = posts.where(when < 1704067200 + 10 * 86400)
    source, out, checkpoint = (scratch_path(spark, n) for n in ("late", "unique", "checkpoint"))
    for portion in (newest.select(*POST_SCHEMA.names).unionByName(ahead), middle, oldest, newest):
        portion.write.mode("append").option("ignoreNullFields", "false").json(source)
        unique = dedupe_stream(read_posts_stream(spark, source)).select(*POST_SCHEMA.names)
        run(start_ndjson_sink(unique, out, checkpoint, once=True))
    return read_posts(spark, out).select("type", "id", "created_utc")


_FIRST = r"regexp_extract(lower(body), '(^|[^\pL\pM\pN_])(onnd|treoié|la)([^\pL\pM\pN_]|$)', 2)"
_FEED = f"""WITH subs AS ({_SUBMISSION.replace('md5(', '(')}), coms AS ({_COMMENT.replace('md5(', '(')}),
feed AS (SELECT id, type, digest AS body FROM subs UNION ALL SELECT id, type, digest FROM coms)
SELECT id, type, {_FIRST} AS brand, md5(body) AS digest FROM feed WHERE {_FIRST} <> ''"""


@query("e3_live_ingest", _FEED)
def live_ingest(spark, sf):
    """Both raw feeds through matching and dedupe into NDJSON files."""
    subs, coms = scratch_path(spark, "submissions"), scratch_path(spark, "comments")
    V.submissions(spark, sf).write.json(subs)
    V.comments(spark, sf).write.json(coms)
    out = scratch_path(spark, "ingest")
    run(
        start_ingest(
            read_posts_stream(spark, subs, schema=SUBMISSION_SCHEMA),
            read_posts_stream(spark, coms, schema=COMMENT_SCHEMA),
            ["onnd", "treoié", "La"], out, scratch_path(spark, "checkpoint"),
            delay="60 days", now=V.NOW, once=True,
        )
    )
    return read_posts(spark, out).select("id", "type", "brand", F.md5("text").alias("digest"))


_LIVE = O.POSTS + """,
hits AS (SELECT id, min(text) AS text FROM posts WHERE contains(lower(text), 'oning')
  OR contains(lower(text), 'thble') GROUP BY id)""" + "," + O.scores("hits")


@query(
    "t6_live_stream",
    O.select(_LIVE, f"""SELECT make_timestamp(CAST({V.NOW} AS BIGINT) * 1000000) AS ts, count(*) AS mentions,
    {O.MEAN} AS avg_compound, 'v' AS provider FROM scores"""),
)
def live_stream(spark, sf):
    points, folder = scratch_path(spark, "points"), posts_folder(spark, sf, "live")
    run(
        start_live(
            read_posts_stream(spark, folder), points, scratch_path(spark, "checkpoint"),
            ["oning", "thble"], V.LEXICON, track_start=1, backfill_minutes=100_000, delay="90 days",
            rules=V.RULES, clock=lambda: V.NOW, once=True,
        )
    )
    point = read_points(spark, points)
    return point.select("ts", "mentions", F.round("avg_compound", 8).alias("avg_compound"), "provider")


_CLOCKS = (1705500000, 1707000000, 1707500000)
_MATCH = "(contains(lower(text), 'oning') OR contains(lower(text), 'thble'))"


def _portions(posts):
    at = F.col("fetched_at")
    return posts.where(at < _CLOCKS[0]), posts.where((at >= _CLOCKS[0]) & (at < _CLOCKS[1])), posts.where(at >= _CLOCKS[1])


def _live_run(spark, source, points, checkpoint, clock, **more):
    options = {"track_start": 1704067200, "backfill_minutes": 14_400, "delay": "90 days", "rules": V.RULES, "once": True, **more}
    run(start_live(read_posts_stream(spark, source), points, checkpoint, ["oning", "thble"], V.LEXICON, clock=lambda: clock, **options))


_TICKS = O.POSTS + f""",
hits AS (SELECT id, fetched_at FROM posts WHERE {_MATCH}),
one AS (SELECT 1705500000 - 864000 AS since, id, fetched_at FROM hits
  WHERE fetched_at < 1705500000 AND fetched_at >= 1705500000 - 864000),
w1 AS (SELECT max(fetched_at) AS w FROM one),
two AS (SELECT greatest(w, 1707000000 - 864000) AS since, id, fetched_at FROM hits, w1
  WHERE fetched_at >= 1705500000 AND fetched_at < 1707000000 AND fetched_at >= greatest(w, 1707000000 - 864000)),
w2 AS (SELECT greatest(w, (SELECT max(fetched_at) FROM two)) AS w FROM w1),
three AS (SELECT greatest(w, 1707500000 - 864000) AS since, id, fetched_at FROM hits, w2
  WHERE fetched_at >= 1707000000 AND fetched_at >= greatest(w, 1707500000 - 864000)),
all_ticks AS (
  SELECT 0 AS tick, * FROM one UNION ALL SELECT 1, * FROM two UNION ALL SELECT 2, * FROM three),
first AS (SELECT id, min(tick) AS tick FROM all_ticks GROUP BY id),
per_tick AS (SELECT CAST(tick AS BIGINT) AS tick, CAST(max(since) AS DOUBLE) AS since,
  CAST(max(least(fetched_at, 1707500000)) AS DOUBLE) AS waterline, count(*) AS gathered FROM all_ticks GROUP BY tick),
new AS (SELECT tick, count(*) AS mentions FROM first GROUP BY tick)"""


@query(
    "t7_backfill_window_live",
    O.select(_TICKS, "SELECT p.tick, since, waterline, gathered, mentions FROM per_tick p JOIN new USING (tick)"),
)
def backfill_window_live(spark, sf):
    """Three runs on one checkpoint: the window binds in the first two ticks, the waterline in the third."""
    source, points, checkpoint = (scratch_path(spark, n) for n in ("windowed", "points", "checkpoint"))
    for portion, clock in zip(_portions(V.posts(spark, sf).select(*POST_SCHEMA.names)), _CLOCKS):
        portion.write.mode("append").option("ignoreNullFields", "false").json(source)
        _live_run(spark, source, points, checkpoint, clock)
    return read_ticks(spark, checkpoint).select("tick", "since", "waterline", "gathered", "mentions")


@query(
    "t6_live_restart",
    O.select(O.POSTS, f"""SELECT count(DISTINCT id) FILTER (fetched_at < {_CLOCKS[0]}) AS before,
    count(DISTINCT id) - count(DISTINCT id) FILTER (fetched_at < {_CLOCKS[0]}) AS after FROM posts WHERE {_MATCH}"""),
)
def live_restart(spark, sf):
    """A second run on the checkpoint gets all posts again and counts only those that the first one had not."""
    source, points, checkpoint = (scratch_path(spark, n) for n in ("restarted", "points", "checkpoint"))
    posts = V.posts(spark, sf).select(*POST_SCHEMA.names)
    for portion, clock in ((posts.where(F.col("fetched_at") < _CLOCKS[0]), 1704067200), (posts, 1704067201)):
        portion.write.mode("append").option("ignoreNullFields", "false").json(source)
        _live_run(spark, source, points, checkpoint, clock, track_start=1)
    ticks = read_ticks(spark, checkpoint)
    return ticks.agg(
        F.sum(F.when(F.col("tick") == 0, F.col("mentions"))).alias("before"),
        F.sum(F.when(F.col("tick") == 1, F.col("mentions"))).alias("after"),
    )


@query(
    "t8_live_idle",
    O.select(O.POSTS, f"""SELECT * FROM (SELECT count(DISTINCT id) AS mentions, false AS idle FROM posts
      WHERE {_MATCH} AND fetched_at < {_CLOCKS[0]}
    UNION ALL SELECT 0, true
    UNION ALL SELECT count(DISTINCT id), false FROM posts p WHERE {_MATCH} AND fetched_at >= {_CLOCKS[0]} AND
      NOT EXISTS (SELECT 1 FROM posts q WHERE q.id = p.id AND q.fetched_at < {_CLOCKS[0]})) WHERE mentions > 0 OR idle"""),
)
def live_idle(spark, sf):
    """A running view that gets posts, then none, then posts again: points of zeros stand in between."""
    source, points, checkpoint = (scratch_path(spark, n) for n in ("idling", "points", "checkpoint"))
    posts = V.posts(spark, sf).select(*POST_SCHEMA.names)
    early = F.col("fetched_at") < _CLOCKS[0]
    posts.where(early).write.option("ignoreNullFields", "false").json(source)
    clock = itertools.count(1704067200)
    view = start_live(
        read_posts_stream(spark, source), points, checkpoint, ["oning", "thble"], V.LEXICON, track_start=1, backfill_minutes=14_400,
        delay="90 days", rules=V.RULES, trigger="5 seconds", include_idle=True, clock=lambda: next(clock),
    )

    def wait_for(condition):
        """Until some tick after the ones seen so far fulfils the condition."""
        while view.isActive:
            if view.lastProgress and view.lastProgress.batchId > wait_for.tick:
                done = read_ticks(spark, checkpoint).where(F.col("tick") > wait_for.tick).where(condition)
                last = done.agg(F.max("tick")).first()[0]
                if last is not None:
                    wait_for.tick = last
                    return
            time.sleep(0.2)
        raise RuntimeError(str(view.exception()))

    wait_for.tick = -1
    try:
        wait_for("gathered > 0")
        wait_for("gathered = 0")
        posts.where(~early).write.mode("append").option("ignoreNullFields", "false").json(source)
        wait_for("gathered > 0")
        while view.isActive and view.status["isTriggerActive"]:
            time.sleep(0.05)  # stopped between ticks
    finally:
        view.stop()
    found = read_points(spark, points).select("mentions", (F.col("mentions") == 0).alias("idle"))
    # How many idle ticks there were depends on the time that ticks took.
    return found.where("NOT idle").unionByName(found.where("idle").distinct())


@query(
    "f9_live_dropped",
    O.select(O.POSTS, f"""SELECT count(*) FILTER (CAST(id AS BIGINT) % 100 >= 50) AS gathered,
    count(*) FILTER (CAST(id AS BIGINT) % 100 < 50) AS dropped,
    count(DISTINCT id) FILTER (CAST(id AS BIGINT) % 100 >= 50) AS mentions FROM posts WHERE {_MATCH}"""),
)
def live_dropped(spark, sf):
    """Rated posts through the running view; each tick counts what it dropped."""
    source, points, checkpoint = (scratch_path(spark, n) for n in ("rated", "points", "checkpoint"))
    rating = F.format_string('{"compound": 0.5, "relevancy": %.2f}', (F.col("id").cast("long") % 100) / 100)
    V.posts(spark, sf).withColumn("response", rating).write.parquet(source)
    posts = spark.read.parquet(source)
    stream = spark.readStream.schema(posts.schema).parquet(source)
    run(
        start_live(
            stream, points, checkpoint, ["oning", "thble"], V.LEXICON, provider="gemini", track_start=1, backfill_minutes=100_000,
            delay="90 days", clock=lambda: V.NOW, once=True,
        )
    )
    return read_ticks(spark, checkpoint).select("gathered", "dropped", "mentions")
