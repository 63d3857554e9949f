"""Checks of the live view on batches."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks import views as V
from checks.registry import query
from chatterscope.config import brand_keywords, config_frames
from chatterscope.functions.text import contains_any, excerpt
from chatterscope.operators import live
from chatterscope.operators.scoring import score_posts
from chatterscope.operators.tagging import substring_join
from chatterscope.plans.live import live_tick

_DAY = "make_timestamp((fetched_at // 86400) * 86400000000)"


def day(df):
    return df.withColumn("tick", F.timestamp_seconds(F.floor(F.col("fetched_at") / 86400) * 86400))


def scored(df):
    return score_posts(df, V.LEXICON, V.RULES)


@query(
    "f11_brand_keywords",
    """SELECT k.keyword, count(*) AS posts FROM documents, (VALUES ('mentre'), ('license')) k(keyword)
    WHERE contains(lower(text), keyword) GROUP BY k.keyword""",
)
def keywords_of_brand(spark, sf):
    words = brand_keywords(config_frames(spark, V.CONFIG)["brand_dim"], "SRC2")
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    pairs = substring_join(docs, "doc_id", "text", words, "keyword")
    return pairs.groupBy("keyword").agg(F.count(F.lit(1)).alias("posts"))


_LAST = """keyed AS (
  SELECT *, 'id:' || id AS live_key,
    row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC, score DESC NULLS LAST) AS nth FROM posts),
last AS (SELECT * FROM keyed WHERE nth = 1)"""


@query("a13_keep_last", O.select(O.POSTS + "," + _LAST, "SELECT live_key, fetched_at, score FROM last"))
def keep_last(spark, sf):
    frame = live.keep_last(live.with_live_key(V.posts(spark, sf)))
    return frame.select("live_key", "fetched_at", "score")


_SPLIT = 1706000000


def halves(spark, sf):
    keyed = live.with_live_key(V.posts(spark, sf)).select("live_key", "fetched_at")
    return keyed.where(F.col("fetched_at") < _SPLIT), keyed.where(F.col("fetched_at") >= _SPLIT)


@query(
    "j6_unseen",
    O.select(O.POSTS, f"""SELECT 'id:' || id AS live_key, fetched_at FROM posts p WHERE fetched_at >= {_SPLIT}
    AND NOT EXISTS (SELECT 1 FROM posts s WHERE s.id = p.id AND s.fetched_at < {_SPLIT})"""),
)
def unseen(spark, sf):
    old, new = halves(spark, sf)
    return live.unseen(new, old)


@query("u3_add_seen", O.select(O.POSTS, "SELECT DISTINCT 'id:' || id AS live_key FROM posts"))
def add_seen(spark, sf):
    old, new = halves(spark, sf)
    return live.add_seen(old, new)


_POINT_LINK = O.LINK.format("coalesce(nullif(permalink, ''), url)")
_SCORED = O.POSTS + ",\n" + _LAST + "," + O.scores("last") + f""",
rated AS (SELECT l.*, s.compound, {_POINT_LINK} AS top_permalink, {O.EXCERPT.format('text', 400)} AS top_text,
  {_DAY} AS ts FROM last l JOIN scores s ON l.id = s.id),
placed AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY score DESC NULLS LAST, live_key) AS place
  FROM rated),
sums AS (SELECT ts, count(*) AS mentions, {O.MEAN} AS avg_compound FROM rated GROUP BY ts),
points AS (SELECT s.ts, s.mentions, s.avg_compound, p.top_permalink, p.top_text
  FROM sums s JOIN placed p ON s.ts = p.ts AND p.place = 1)""".replace("sums AS", "tick_sums AS").replace("FROM sums s", "FROM tick_sums s")


def day_points(spark, sf):
    last = live.keep_last(live.with_live_key(V.posts(spark, sf)))
    return live.live_points(day(scored(last)), F.col("tick")).withColumn(
        "avg_compound", F.round("avg_compound", 8)
    )


@query("a7_live_points", O.select(_SCORED, "SELECT *, 'v' AS provider FROM points"))
def live_points(spark, sf):
    return day_points(spark, sf)


@query("f10_with_permalink", O.select(_SCORED, "SELECT ts, top_permalink FROM points WHERE top_permalink <> ''"))
def with_permalink(spark, sf):
    return live.with_permalink(day_points(spark, sf)).select("ts", "top_permalink")


@query("l4_last_points", O.select(_SCORED, "SELECT ts, mentions FROM points ORDER BY ts DESC LIMIT 20"))
def last_points(spark, sf):
    return live.last_points(day_points(spark, sf), 20).select("ts", "mentions")


@query(
    "l5_latest_top",
    O.select(_SCORED, """SELECT top_permalink, substr(top_text, 1, 300) AS top_text FROM points
    WHERE top_permalink <> '' ORDER BY ts DESC LIMIT 1"""),
)
def latest_top(spark, sf):
    return live.latest_top(day_points(spark, sf))


@query(
    "l3_top_one",
    O.select(O.POSTS, f"""SELECT {_POINT_LINK} AS top_permalink, {O.EXCERPT.format('text', 400)} AS top_text
    FROM posts ORDER BY score DESC NULLS LAST, id LIMIT 1"""),
)
def top_one(spark, sf):
    return live.top_one(V.posts(spark, sf))


@query(
    "l3_top_one_by_compound",
    """SELECT '' AS top_permalink, props AS top_text FROM events
    ORDER BY least(1e0, value / 250e0 - 1e0) DESC, event_id LIMIT 1""",
)
def top_by_compound(spark, sf):
    rows = V.table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.least(F.lit(1.0), F.col("value") / 250 - 1).alias("compound"),
        F.lit("").alias("permalink"),
        F.col("props").alias("text"),
    )
    return live.top_one(rows)


@query(
    "t8_fill_idle_ticks",
    """WITH counted AS (SELECT epoch_us(ts) // 60000000 AS minute, count(*) AS n FROM events GROUP BY 1),
    ticks AS (SELECT unnest(range(28401120, 28401120 + 30 * 1440)) AS minute)
    SELECT make_timestamp(t.minute * 60000000) AS ts, coalesce(n, 0) AS mentions
    FROM ticks t LEFT JOIN counted c ON t.minute = c.minute""",
)
def fill_idle(spark, sf):
    minutes = V.scored_events(spark, sf).select(
        F.date_trunc("minute", "event_ts").alias("tick"), "compound",
        F.lit("").alias("permalink"), F.lit("").alias("text"), "id",
    )
    points = live.live_points(minutes, F.col("tick"))
    start = 28401120 * 60
    return live.fill_idle_ticks(points, start, start + 30 * 86400 - 60, 60).select("ts", "mentions")


_EPOCH, _TICK = 1707000000, "2024-02-28 12:00:00"
KEYWORDS = ["oning", "Thble"]


def tick(spark, sf):
    rows = V.posts(spark, sf)
    seen = live.with_live_key(rows.where((F.col("fetched_at") < _EPOCH) & (F.col("score") > 20)))
    return live_tick(rows, seen.select("live_key"), _EPOCH, _TICK, KEYWORDS, V.LEXICON, rules=V.RULES)


_GATHERED = O.POSTS + f""",
raw AS (SELECT * FROM posts WHERE fetched_at >= {_EPOCH}
  AND (contains(lower(text), 'oning') OR contains(lower(text), 'thble'))),
seen AS (SELECT DISTINCT id FROM posts WHERE fetched_at < {_EPOCH} AND score > 20),
numbered AS (SELECT *, 'id:' || id AS live_key, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC) AS nth FROM raw),
fresh AS (SELECT * FROM numbered WHERE nth = 1 AND id NOT IN (SELECT id FROM seen))"""


@query(
    "t6_live_tick",
    O.select(_GATHERED + "," + O.scores("fresh") + f""",
    rated AS (SELECT f.*, s.compound FROM fresh f JOIN scores s ON f.id = s.id),
    best AS (SELECT {_POINT_LINK} AS top_permalink, {O.EXCERPT.format('text', 400)} AS top_text FROM rated
      ORDER BY score DESC NULLS LAST, live_key LIMIT 1)""",
    f"""SELECT TIMESTAMP '{_TICK}' AS ts, (SELECT count(*) FROM rated) AS mentions,
    (SELECT {O.MEAN} FROM rated) AS avg_compound, top_permalink, top_text,
    'v' AS provider FROM best"""),
)
def tick_point(spark, sf):
    return tick(spark, sf).point.withColumn("avg_compound", F.round("avg_compound", 8))


@query(
    "t6_live_tick_state",
    O.select(_GATHERED, """SELECT (SELECT count(*) FROM (SELECT id FROM seen UNION SELECT id FROM fresh))
    AS seen, (SELECT CAST(max(fetched_at) AS DOUBLE) FROM raw) AS waterline"""),
)
def tick_state(spark, sf):
    state = tick(spark, sf)
    seen = state.seen.agg(F.count(F.lit(1)).alias("seen"))
    return seen.withColumn("waterline", state.waterline.scalar())


@query(
    "t7_backfill_window",
    O.select(O.POSTS, """SELECT count(*) AS posts FROM posts WHERE fetched_at >= 1706999400"""),
)
def backfill_window(spark, sf):
    """A session that began late reaches back by at most the window; here the waterline is later."""
    epoch = live.live_since(1706999400, 1706000000, 1707000000, backfill_minutes=60)
    return live.since(V.posts(spark, sf), epoch).agg(F.count(F.lit(1)).alias("posts"))


@query(
    "t7_backfill_window_binds",
    O.select(O.POSTS, """SELECT count(*) AS posts FROM posts WHERE fetched_at >= 1706996400"""),
)
def backfill_window_binds(spark, sf):
    """The waterline lies days back; the window of an hour decides."""
    epoch = live.live_since(1706000000, 1705000000, 1707000000, backfill_minutes=60)
    return live.since(V.posts(spark, sf), epoch).agg(F.count(F.lit(1)).alias("posts"))


@query(
    "f3_live_match",
    O.select(O.POSTS, f"""SELECT id, fetched_at, {O.EXCERPT.format('text', 300)} AS caption FROM posts
    WHERE contains(lower(text), 'oning') OR contains(lower(text), 'thble')"""),
)
def live_match(spark, sf):
    hits = V.posts(spark, sf).where(contains_any("text", KEYWORDS))
    return hits.select("id", "fetched_at", excerpt("text", 300).alias("caption"))
