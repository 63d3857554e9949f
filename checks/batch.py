"""Checks of the batch job: dedupe, tagging, scoring, aggregation, ranking and the written tables."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks import views as V
from checks.registry import query
from chatterscope.config import config_frames
from chatterscope.functions import sentiment
from chatterscope.operators import aggregates, ranking, scoring, serving, tagging
from chatterscope.operators.clean import clean_posts
from chatterscope.plans import batch
from chatterscope.session import scratch_path
from chatterscope.sinks import tables as sinks
from chatterscope.sources import tables as sources

_TABLES = {}


def unique(spark, sf):
    return ranking.dedupe_posts(clean_posts(V.posts(spark, sf)))


def scored(spark, sf):
    return batch.scored_posts(V.posts(spark, sf), V.CONFIG, V.LEXICON, rules=V.RULES)


def daily(spark, sf):
    return batch.daily_from_posts(V.posts(spark, sf), V.CONFIG, V.LEXICON, rules=V.RULES)


def written(spark, sf):
    """The tables of the batch job, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TABLES:
        _TABLES[key] = batch.run_batch(
            spark, V.posts(spark, sf), scratch_path(spark, "tables"), V.CONFIG, V.LEXICON,
            rules=V.RULES,
        )
    return _TABLES[key]


def joined(tags):
    return F.array_join(F.array_sort(tags), ",")


@query(
    "w1_dedupe_posts",
    O.select(O.UNIQUE, "SELECT id, created_utc, fetched_at, score, permalink, md5(text) AS digest FROM uniq"),
)
def dedupe(spark, sf):
    return unique(spark, sf).select(
        "id", "created_utc", "fetched_at", "score", "permalink", F.md5("text").alias("digest")
    )


_BRANDS = """concat_ws(',', CASE WHEN kw3 THEN 'gamma' END, CASE WHEN kw1 THEN 'src1' END,
  CASE WHEN kw2 THEN 'src2' END) AS brands"""
_ALL_BRANDS = """concat_ws(',', CASE WHEN kw3 THEN 'gamma' END, CASE WHEN kw1 OR hint1 THEN 'src1' END,
  CASE WHEN kw2 OR hint2 THEN 'src2' END) AS brands"""


@query("j1_match_brands", O.select(O.TAGGED, f"SELECT id, {_BRANDS} FROM found"))
def match_brands(spark, sf):
    tagged = tagging.match_brands(unique(spark, sf), V.CONFIG)
    return tagged.select("id", joined("brands").alias("brands"))


@query("j1_match_brands_join", O.select(O.TAGGED, f"SELECT id, {_BRANDS} FROM found"))
def match_brands_join(spark, sf):
    narrow = unique(spark, sf).select("id", "text")
    tagged = tagging.match_brands(narrow, V.CONFIG, mode="join")
    return tagged.select("id", joined("brands").alias("brands"))


@query("j2_match_events", O.select(O.TAGGED, "SELECT id, tags FROM found"))
def match_events(spark, sf):
    tagged = tagging.match_events(unique(spark, sf), V.CONFIG)
    return tagged.select("id", joined("event_tags").alias("tags"))


@query("j2_match_events_join", O.select(O.TAGGED, "SELECT id, tags FROM found"))
def match_events_join(spark, sf):
    narrow = unique(spark, sf).select("id", "text")
    tagged = tagging.match_events(narrow, V.CONFIG, mode="join")
    return tagged.select("id", joined("event_tags").alias("tags"))


@query("j1_match_brands_shuffled", O.select(O.TAGGED, f"SELECT id, {_BRANDS} FROM found"))
def match_brands_shuffled(spark, sf):
    """The form for keyword tables that are too large to be copied."""
    terms = config_frames(spark, V.CONFIG)["keyword_dim"]
    tagged = tagging.match_terms(unique(spark, sf).select("id", "text"), terms, method="join")
    return tagged.select("id", joined("brands").alias("brands"))


@query(
    "j1_document_keywords",
    O.select(O.POSTS + """,
    words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{11,}')) AS word FROM documents),
    known AS (SELECT word FROM words GROUP BY word HAVING count(*) >= 2),
    hits AS (SELECT p.id, p.fetched_at, k.word FROM posts p JOIN known k ON contains(lower(p.text), k.word)),
    brands AS (SELECT left(word, 2) AS brand, count(DISTINCT (id, fetched_at)) AS posts FROM hits GROUP BY 1)""",
             "SELECT brand, posts FROM brands"),
)
def document_keywords(spark, sf):
    """Thousands of keywords: the long words that several documents have, by their first two letters."""
    words = V.table(spark, sf, "documents").select(
        "doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{11,}"), F.lit(0))).alias("keyword")
    )
    known = words.distinct().groupBy("keyword").count().where("count >= 2")
    terms = known.select(F.crc32(F.left("keyword", F.lit(2)).cast("binary")).alias("position"),
                         F.left("keyword", F.lit(2)).alias("canonical"), "keyword")
    tagged = tagging.match_terms(V.posts(spark, sf).select("text"), terms)
    return tagged.select(F.explode("brands").alias("brand")).groupBy("brand").agg(F.count(F.lit(1)).alias("posts"))


@query("j4_tag_posts_tables", O.select(O.TAGGED, f"SELECT id, {_ALL_BRANDS}, tags FROM found"))
def tag_posts_tables(spark, sf):
    dims = config_frames(spark, V.CONFIG)
    hints = tagging.subreddit_hints(dims["brand_dim"], dims["subreddit_dim"])
    tables = tagging.KeywordTables(dims["keyword_dim"], dims["event_dim"], hints)
    tagged = tagging.tag_posts(unique(spark, sf), tables=tables)
    return tagged.select("id", joined("brands").alias("brands"), joined("event_tags").alias("tags"))


@query(
    "j3_subreddit_hints",
    """WITH subs AS (SELECT DISTINCT lower(source) AS subreddit FROM documents)
    SELECT subreddit, canonical, count(*) AS pairs FROM subs, (VALUES ('src1'), ('src2'), ('gamma')) b(canonical)
    WHERE contains(subreddit, canonical) GROUP BY ALL""",
)
def subreddit_hints(spark, sf):
    subs = V.posts(spark, sf).select("subreddit").distinct()
    brands = config_frames(spark, V.CONFIG)["brand_dim"]
    pairs = tagging.subreddit_hints(brands, subs)
    return pairs.groupBy("subreddit", "canonical").agg(F.count(F.lit(1)).alias("pairs"))


@query("j4_add_hints", O.select(O.TAGGED, f"SELECT id, {_ALL_BRANDS} FROM found"))
def add_hints(spark, sf):
    tagged = tagging.match_brands(unique(spark, sf), V.CONFIG)
    hinted = tagging.add_hints(tagged, tagging.hints_of(V.CONFIG))
    return hinted.select("id", joined("brands").alias("brands"))


@query("j4_add_hints_join", O.select(O.TAGGED, f"SELECT id, {_ALL_BRANDS} FROM found"))
def add_hints_join(spark, sf):
    dims = config_frames(spark, V.CONFIG)
    hints = tagging.subreddit_hints(dims["brand_dim"], dims["subreddit_dim"])
    tagged = tagging.match_brands(unique(spark, sf), V.CONFIG)
    return tagging.add_hints(tagged, hints).select("id", joined("brands").alias("brands"))


@query("f2_has_brand", O.select(O.TAGGED, "SELECT DISTINCT id FROM tagged"))
def has_brand(spark, sf):
    return batch.tagged_posts(V.posts(spark, sf), V.CONFIG).select("id")


@query("p23_explode_brands", O.select(O.TAGGED, "SELECT id, brand, tags FROM tagged"))
def explode_brands(spark, sf):
    tagged = batch.tagged_posts(V.posts(spark, sf), V.CONFIG)
    return tagging.explode_brands(tagged).select("id", "brand", joined("event_tags").alias("tags"))


@query("a12_array_distinct", O.select(O.TAGGED, f"SELECT brands, count(*) AS posts FROM (SELECT {_ALL_BRANDS} FROM found) GROUP BY brands"))
def array_distinct(spark, sf):
    tagged = tagging.tag_posts(unique(spark, sf), V.CONFIG)
    repeated = F.array_distinct(F.concat("brands", "brands"))
    return tagged.groupBy(joined(repeated).alias("brands")).agg(F.count(F.lit(1)).alias("posts"))


@query(
    "s7_config_keyword_counts",
    O.select(O.UNIQUE, """SELECT k.canonical, k.keyword, count(*) AS posts FROM uniq,
    (VALUES ('src1', 'oning'), ('src1', 'thble'), ('src2', 'mentre'), ('src2', 'license'),
    ('gamma', 'ingre')) k(canonical, keyword) WHERE contains(lower(text), keyword) GROUP BY ALL"""),
)
def config_keyword_counts(spark, sf):
    keywords = config_frames(spark, V.CONFIG)["keyword_dim"]
    pairs = tagging.substring_join(unique(spark, sf), "id", "text", keywords, "keyword")
    return pairs.groupBy("canonical", "keyword").agg(F.count(F.lit(1)).alias("posts"))


_SCORES = O.select(O.UNIQUE + "," + O.scores("uniq"), "SELECT id, compound FROM scores")


@query("x1_compound", _SCORES)
def compound(spark, sf):
    return scoring.score_posts(unique(spark, sf).select("id", "text"), V.LEXICON, V.RULES).select(
        "id", "compound"
    )


@query("x1_compound_join", _SCORES)
def compound_join(spark, sf):
    lexicon = spark.createDataFrame(list(V.LEXICON.items()), "token string, valence double")
    narrow = unique(spark, sf).select("id", "text")
    return scoring.score_by_join(narrow, lexicon, V.RULES).select("id", "compound")


@query("x1_compound_words", _SCORES)
def compound_words(spark, sf):
    """A row for each word: the form for texts with too many words to be copied."""
    lexicon = spark.createDataFrame(list(V.LEXICON.items()), "token string, valence double")
    narrow = unique(spark, sf).select("id", "text")
    return scoring.score_by_words(narrow, lexicon, V.RULES).select("id", "compound")


@query("x1_compound_expression", _SCORES)
def compound_expression(spark, sf):
    """The form that stays in the JVM."""
    return unique(spark, sf).select("id", sentiment.compound("text", V.LEXICON, V.RULES).alias("compound"))


@query(
    "v1_plugged_scorer",
    "SELECT doc_id, least(length(text), 1000) / 1000e0 AS compound FROM documents",
)
def plugged_scorer(spark, sf):
    scorer = scoring.pandas_scorer(lambda texts: [min(len(t), 1000) / 1000 for t in texts])
    return scoring.score_posts(V.table(spark, sf, "documents"), scorer=scorer).select("doc_id", "compound")


def _daily_sql(column):
    return O.select(O.DAILY, f"SELECT brand, event_date, {column} FROM daily")


@query("a1_daily_mentions", _daily_sql("mentions"))
def daily_mentions(spark, sf):
    return daily(spark, sf).select("brand", "event_date", "mentions")


@query("a2_daily_compound", _daily_sql("mean_compound AS avg_compound"))
def daily_compound(spark, sf):
    return daily(spark, sf).select("brand", "event_date", F.round("avg_compound", 8).alias("avg_compound"))


@query("a3_daily_sentiments", _daily_sql("positive, negative, neutral"))
def daily_sentiments(spark, sf):
    return daily(spark, sf).select("brand", "event_date", "positive", "negative", "neutral")


@query("a4_daily_event_hits", _daily_sql("event_hits"))
def daily_event_hits(spark, sf):
    return daily(spark, sf).select("brand", "event_date", "event_hits")


@query("a5_daily_event_posts", _daily_sql("event_posts"))
def daily_event_posts(spark, sf):
    return daily(spark, sf).select("brand", "event_date", "event_posts")


@query("a6_daily_max_score", _daily_sql("max_score"))
def daily_max_score(spark, sf):
    return daily(spark, sf).select("brand", "event_date", "max_score")


DAILY_COLUMNS = (
    "brand, event_date, mentions, mean_compound AS avg_compound, positive, negative, "
    "neutral, event_hits, event_posts, max_score, year, month"
)


def rounded(df):
    return df.withColumn("avg_compound", F.round("avg_compound", 8))


@query("daily_aggregate", O.select(O.DAILY, f"SELECT {DAILY_COLUMNS} FROM daily"))
def daily_aggregate(spark, sf):
    return rounded(aggregates.with_month(daily(spark, sf)))


_ROLLED = ", ".join(
    f"round(avg({c}) OVER w, 8) AS {c}_roll7" for c in ranking.ROLLING_COLUMNS
)


@query(
    "w3_rolling_mean",
    O.select(O.DAILY, f"""SELECT brand, event_date, {_ROLLED} FROM daily WINDOW w AS
    (PARTITION BY brand, year ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
)
def rolling_mean(spark, sf):
    rolled = ranking.rolling_mean(aggregates.with_month(daily(spark, sf)))
    means = [F.round(f"{c}_roll7", 8).alias(f"{c}_roll7") for c in ranking.ROLLING_COLUMNS]
    return rolled.select("brand", "event_date", *means)


_TOPS = """brand, year, month, id, type, subreddit, author, event_ts, score, num_comments, url,
  permalink, compound, sentiment, tags, md5(text) AS digest"""


def _shown(tops):
    return (
        tops.withColumn("tags", joined("event_tags"))
        .withColumn("digest", F.md5("text"))
        .drop("event_tags", "text")
    )


@query("w2_monthly_top", O.select(O.TOPS, "SELECT brand, year, month, id, score FROM tops"))
def monthly_top(spark, sf):
    stored = sources.read_posts_table(spark, written(spark, sf))
    return ranking.monthly_top(stored).select("brand", "year", "month", "id", "score")


@query("p7_tops_columns", O.select(O.TOPS, f"SELECT {_TOPS} FROM tops"))
def tops_columns(spark, sf):
    stored = sources.read_posts_table(spark, written(spark, sf))
    return _shown(serving.select_tops(ranking.monthly_top(stored)))


@query("w4_top_post_per_day", O.select(O.BEST, "SELECT * FROM best"))
def top_post_per_day(spark, sf):
    return ranking.top_post_per_day(scored(spark, sf))


@query(
    "j5_attach_top_post",
    O.select(O.BEST + "," + O.DAILY.split("scored AS", 1)[1].split("),", 1)[1],
             "SELECT d.brand, d.event_date, mentions, top_permalink, top_text FROM daily d "
             "LEFT JOIN best b ON d.brand = b.brand AND d.event_date = b.event_date"),
)
def attach_top_post(spark, sf):
    base = written(spark, sf)
    frame = ranking.attach_top_post(sources.read_daily(spark, base), sources.read_posts_table(spark, base))
    return frame.select("brand", "event_date", "mentions", "top_permalink", "top_text")


_POSTS = f"""id, type, subreddit, author, created_utc, url, score, num_comments, parent_id, fetched_at,
  permalink, event_ts, event_date, tags, compound, sentiment, event_hit, year, month, day, brand,
  md5(text) AS digest"""


@query("k1_posts_sink", O.select(O.SCORED, f"SELECT {_POSTS} FROM scored"))
def posts_sink(spark, sf):
    return _shown(sources.read_posts_table(spark, written(spark, sf)))


@query("k2_daily_sink", O.select(O.DAILY, f"SELECT {DAILY_COLUMNS} FROM daily"))
def daily_sink(spark, sf):
    base = scratch_path(spark, "daily")
    sinks.write_daily(daily(spark, sf), base)
    return rounded(sources.read_daily(spark, base))


@query("k3_tops_sink", O.select(O.TOPS, f"SELECT {_TOPS} FROM tops"))
def tops_sink(spark, sf):
    base = scratch_path(spark, "tops")
    stored = sources.read_posts_table(spark, written(spark, sf))
    sinks.write_tops(serving.select_tops(ranking.monthly_top(stored)), base, grouped=True)
    return _shown(sources.read_tops(spark, base))


@query("k7_refresh", O.select(O.DAILY, "SELECT brand, mentions FROM daily WHERE brand = 'src1'"))
def refresh(spark, sf):
    """A cached table whose files another job exchanges must show the new rows after the refresh.

    Spark's own writes refresh the cache by themselves, so the folder is exchanged behind its back.
    """
    base, other = scratch_path(spark, "refreshed"), scratch_path(spark, "refreshing")
    table = sinks.write_daily(daily(spark, sf), base)
    sources.read_daily(spark, base).select("brand", "mentions").cache().count()
    fresh = sources.read_daily(spark, written(spark, sf)).where(F.col("brand") == "src1")
    new = sinks.write_daily(fresh.drop("year", "month"), other)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(path(table), path(f"{other}/before"))
    files.rename(path(new), path(table))
    sinks.refresh(spark, table)
    return sources.read_daily(spark, base).select("brand", "mentions")


@query("s4_read_daily", O.select(O.DAILY, f"SELECT {DAILY_COLUMNS} FROM daily"))
def read_daily(spark, sf):
    return rounded(sources.read_daily(spark, written(spark, sf)))


@query("s5_read_tops", O.select(O.TOPS, f"SELECT {_TOPS} FROM tops"))
def read_tops(spark, sf):
    return _shown(sources.read_tops(spark, written(spark, sf)))


@query(
    "s6_read_posts_for",
    O.select(O.SCORED, f"SELECT {_POSTS} FROM scored WHERE event_date = DATE '2024-01-15' AND brand = 'src1'"),
)
def read_posts_for(spark, sf):
    return _shown(sources.read_posts_for(spark, written(spark, sf), "2024-01-15", "src1"))
