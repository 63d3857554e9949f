"""Checks of column functions and predicates."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks import views as V
from checks.registry import query
from chatterscope.config import clean_keywords
from chatterscope.functions import keys, responses, sentiment, text, times
from chatterscope.operators import clean, ingest, live, ranking, tagging

_WORDS = ["onnd", "ios", "Is and"]


@query("p1_collapse_ws", O.select(O.CLEAN, "SELECT id, fetched_at, md5(text) AS digest FROM clean"))
def collapse_ws(spark, sf):
    return V.posts(spark, sf).select("id", "fetched_at", F.md5(text.collapse_ws("text")).alias("digest"))


@query("p2_event_ts", O.select(O.CLEAN, "SELECT id, fetched_at, event_ts FROM clean"))
def event_ts(spark, sf):
    return V.posts(spark, sf).select("id", "fetched_at", times.event_ts("created_utc").alias("event_ts"))


@query("p3_event_date", O.select(O.CLEAN, "SELECT event_date, count(*) AS posts FROM clean GROUP BY 1"))
def event_date(spark, sf):
    day = times.event_date(times.event_ts("created_utc")).alias("event_date")
    return V.posts(spark, sf).groupBy(day).agg(F.count(F.lit(1)).alias("posts"))


@query(
    "p4_date_parts",
    O.select(O.CLEAN, "SELECT year, month, day, count(*) AS posts FROM dated GROUP BY ALL"),
)
def date_parts(spark, sf):
    return clean.clean_posts(V.posts(spark, sf)).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("posts")
    )


@query("p5_text_lc", O.select(O.POSTS, "SELECT id, fetched_at, md5(lower(text)) AS digest FROM posts"))
def text_lc(spark, sf):
    return V.posts(spark, sf).select("id", "fetched_at", F.md5(text.text_lc("text")).alias("digest"))


@query("p6_drop_helpers", O.select(O.UNIQUE, "SELECT * EXCLUDE (rn, text, fetched_at), NULL AS brand FROM uniq"))
def drop_helpers(spark, sf):
    unique = clean.clean_posts(V.posts(spark, sf))
    return ranking.dedupe_posts(unique).drop("text", "fetched_at").withColumn(
        "brand", F.col("brand").cast("int")
    )


@query(
    "p10_sentiment_label",
    f"""WITH e AS (SELECT event_type, round(least(1e0, value / 250e0 - 1e0), 4) AS compound FROM events)
    SELECT event_type, {O.LABEL} AS sentiment, count(*) AS n FROM e GROUP BY ALL""",
)
def sentiment_label(spark, sf):
    return (
        V.scored_events(spark, sf)
        .groupBy(
            F.col("brand").alias("event_type"), sentiment.sentiment_label("compound").alias("sentiment")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("p11_event_hit", O.select(O.TAGGED, "SELECT id, tags <> '' AS event_hit FROM found"))
def event_hit(spark, sf):
    unique = ranking.dedupe_posts(clean.clean_posts(V.posts(spark, sf)))
    tagged = tagging.match_events(unique, V.CONFIG)
    return tagged.select("id", sentiment.event_hit("event_tags").alias("event_hit"))


@query(
    "p12_provider_label",
    """SELECT event_type, CASE WHEN event_id % 3 = 0 THEN 'g' ELSE 'v' END AS provider,
    count(*) AS n FROM events GROUP BY ALL""",
)
def provider_label(spark, sf):
    named = F.when(F.col("event_id") % 3 == 0, "gemini").otherwise("lexicon")
    return (
        V.table(spark, sf, "events")
        .groupBy("event_type", text.provider_label(named).alias("provider"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "p13_compound_label",
    """SELECT event_id, printf('%.3f (%s)', CASE WHEN event_id % 2 = 0
    THEN (event_id % 201 - 100) / 128e0 ELSE round(least(1e0, value / 250e0 - 1e0), 4) END,
    CASE WHEN event_id % 3 = 0 THEN 'g' ELSE 'v' END) AS label FROM events""",
)
def compound_label(spark, sf):
    """Half of the scores are exact middles between two labels, the others have four decimals."""
    event = F.col("id").cast("long")
    score = F.when(event % 2 == 0, (event % 201 - 100) / 128).otherwise(F.col("compound"))
    label = text.compound_label(score, F.when(event % 3 == 0, "g").otherwise("v"))
    return V.scored_events(spark, sf).select(event.alias("event_id"), label.alias("label"))


@query(
    "p14_markdown_link",
    O.select(O.POSTS, """SELECT id, fetched_at, CASE WHEN permalink IS NULL THEN ''
    ELSE '[Open](' || permalink || ')' END AS link FROM posts"""),
)
def markdown_link(spark, sf):
    return V.posts(spark, sf).select("id", "fetched_at", text.markdown_link("permalink").alias("link"))


@query(
    "p15_absolute_permalink",
    O.select(O.POSTS, f"SELECT id, fetched_at, {O.LINK.format('permalink')} AS link FROM posts"),
)
def absolute_permalink(spark, sf):
    return V.posts(spark, sf).select(
        "id", "fetched_at", text.absolute_permalink("permalink").alias("link")
    )


@query(
    "p16_excerpt",
    O.select(O.POSTS, f"SELECT id, fetched_at, {O.EXCERPT.format('text', 400)} AS shown FROM posts"),
)
def excerpt(spark, sf):
    return V.posts(spark, sf).select("id", "fetched_at", text.excerpt("text").alias("shown"))


_STAMP = """CASE event_id % 5 WHEN 0 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
  WHEN 1 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 3 THEN 'junk' END"""


def mixed_stamps(spark, sf):
    """Event times in the notations that feeds use."""
    micros, kind = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id") % 5
    stamp = (
        F.when(kind == 0, F.floor(micros / 1000000).cast("string"))
        .when(kind == 1, F.floor(micros / 1000).cast("string"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 3, F.lit("junk"))
    )
    return V.table(spark, sf, "events").select("event_id", stamp.alias("stamp"))


@query(
    "p17_epoch_seconds",
    """SELECT event_id, CASE WHEN event_id % 5 < 3
    THEN CAST(epoch_us(ts) // 1000000 AS DOUBLE) END AS epoch FROM events""",
)
def epoch_seconds(spark, sf):
    return mixed_stamps(spark, sf).select("event_id", times.to_epoch_seconds("stamp").alias("epoch"))


_TITLE = "' ' || source || ' ' || CAST(doc_id AS VARCHAR)"
_BODY = "CASE WHEN doc_id % 6 <> 0 THEN text ELSE '' END"
SUBMISSION_TEXT = O.EXCERPT.replace("substr(", "").replace(", 1, {1})", "").replace(
    "replace({0}, chr(10), ' ')", f"{_TITLE} || chr(10) || {_BODY}"
).replace("{{", "{").replace("}}", "}")


@query("p18_submission_text", f"SELECT CAST(doc_id AS VARCHAR) AS id, md5({SUBMISSION_TEXT}) AS digest FROM documents")
def submission_text(spark, sf):
    return V.submissions(spark, sf).select(
        "id", F.md5(text.submission_text("title", "selftext")).alias("digest")
    )


@query(
    "p19_ingest_defaults",
    """SELECT CAST(doc_id AS VARCHAR) AS id,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'u' || CAST(doc_id % 25 AS VARCHAR) END AS author,
    CASE WHEN doc_id % 17 = 0 THEN 0 ELSE (doc_id * 37) % 31 END AS score,
    CASE WHEN doc_id % 13 = 0 THEN 0 ELSE (doc_id * 13) % 50 END AS num_comments FROM documents""",
)
def ingest_defaults(spark, sf):
    raw = V.submissions(spark, sf).withColumn("author", F.col("author.name"))
    return ingest.ingest_defaults(raw).select("id", "author", "score", "num_comments")


@query(
    "p20_stamp_fetched",
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, CAST({V.NOW} AS BIGINT) AS fetched_at,
    CASE WHEN doc_id % 11 = 0 THEN {V.NOW} ELSE 1704067200 + (doc_id * 79193) % 5184000 END
    AS created_utc FROM documents""",
)
def stamp_fetched(spark, sf):
    return ingest.stamp_fetched(V.submissions(spark, sf), V.NOW).select(
        "id", "fetched_at", "created_utc"
    )


_KEYED = """keyed AS (
  SELECT *, CASE WHEN doc_id % 4 = 0 THEN '  ' WHEN doc_id % 4 = 1 THEN NULL ELSE id END AS kid,
    CASE WHEN doc_id % 3 <> 0 THEN ' ' || permalink END AS klink,
    CASE WHEN doc_id % 8 <> 0 THEN url END AS kurl FROM (SELECT *, CAST(id AS BIGINT) AS doc_id FROM posts))"""


@query(
    "p21_live_key",
    O.select(O.POSTS + ",\n" + _KEYED, """SELECT id, CASE WHEN trim(coalesce(kid, '')) <> '' THEN 'id:' || kid
    WHEN trim(coalesce(klink, '')) <> '' THEN 'permalink:' || trim(klink)
    WHEN coalesce(kurl, '') <> '' THEN 'url:' || kurl
    ELSE 'ts:' || CAST(created_utc AS VARCHAR) || ':sr:' || subreddit || ':a:' || author END
    AS live_key FROM keyed"""),
)
def live_key(spark, sf):
    return live_keys(V.posts(spark, sf)).drop("fetched_at")


def live_keys(posts):
    n = F.col("id").cast("long")
    keyed = posts.withColumn("shown", F.col("id")).withColumns(
        {
            "permalink": F.when(n % 3 != 0, F.concat(F.lit(" "), "permalink")),
            "url": F.when(n % 8 != 0, F.col("url")),
            "id": F.when(n % 4 == 0, "  ").when(n % 4 == 1, F.lit(None)).otherwise(F.col("id")),
        }
    )
    return keyed.select(F.col("shown").alias("id"), "fetched_at", keys.live_key(keyed).alias("live_key"))


@query(
    "p21_live_key_versions",
    O.select(O.POSTS + ",\n" + _KEYED, """SELECT id, fetched_at, CASE WHEN trim(coalesce(kid, '')) <> '' THEN 'id:' || kid
    WHEN trim(coalesce(klink, '')) <> '' THEN 'permalink:' || trim(klink)
    WHEN coalesce(kurl, '') <> '' THEN 'url:' || kurl
    ELSE 'ts:' || CAST(created_utc AS VARCHAR) || ':sr:' || subreddit || ':a:' || author END
    AS live_key FROM keyed"""),
)
def live_key_versions(spark, sf):
    return live_keys(V.posts(spark, sf))


@query(
    "p22_clamp",
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN greatest(-1e0, least(1e0, value / 50e0 - 2e0))
    END AS clamped FROM events""",
)
def clamp(spark, sf):
    raw = F.when(F.col("event_id") % 9 != 0, F.col("value") / 50 - 2)
    return V.table(spark, sf, "events").select("event_id", responses.clamp(raw, -1.0, 1.0).alias("clamped"))


@query("f1_filter_year", O.select(O.CLEAN, "SELECT id, fetched_at, year FROM dated WHERE year = '2024'"))
def filter_year(spark, sf):
    in_year = clean.filter_year(V.posts(spark, sf), 2024)
    return clean.clean_posts(in_year).select("id", "fetched_at", "year")


@query(
    "f3_contains_any",
    """SELECT doc_id FROM documents WHERE lower(text) LIKE '%ios%' OR lower(text) LIKE '%license%'""",
)
def contains_any(spark, sf):
    return V.table(spark, sf, "documents").where(text.contains_any("text", ["IOS", "license"])).select("doc_id")


@query(
    "f4_word_match",
    r"""SELECT doc_id FROM documents WHERE regexp_matches(lower(text),
    '(^|[^\pL\pM\pN_])(onnd|ios|is and)([^\pL\pM\pN_]|$)')""",
)
def word_match(spark, sf):
    return V.table(spark, sf, "documents").where(text.word_match("text", _WORDS)).select("doc_id")


@query(
    "x2_extract_brand",
    r"""SELECT doc_id, regexp_extract(lower(text),
    '(^|[^\pL\pM\pN_])(onnd|ios|is and)([^\pL\pM\pN_]|$)', 2) AS brand FROM documents
    WHERE regexp_matches(lower(text), '(^|[^\pL\pM\pN_])(onnd|ios|is and)([^\pL\pM\pN_]|$)')""",
)
def extract_brand(spark, sf):
    return tagging.extract_brand(V.table(spark, sf, "documents"), _WORDS).select("doc_id", "brand")


@query(
    "f7_since",
    """SELECT event_id FROM events WHERE event_id % 5 < 3
    AND epoch_us(ts) // 1000000 >= 1705000000""",
)
def since(spark, sf):
    rows = mixed_stamps(spark, sf).withColumnRenamed("stamp", "fetched_at")
    return live.since(rows, 1705000000).select("event_id")


@query(
    "a11_waterline",
    """SELECT CAST(max(epoch_us(ts) // 1000000) AS DOUBLE) AS waterline FROM events
    WHERE event_id % 5 < 3""",
)
def waterline(spark, sf):
    return live.waterline(mixed_stamps(spark, sf).withColumnRenamed("stamp", "fetched_at"))


@query(
    "x6_clean_keywords",
    """SELECT count(*) AS posts FROM documents WHERE lower(text) LIKE '%oning%'
    OR lower(text) LIKE '%thble%'""",
)
def hygiene(spark, sf):
    words = clean_keywords([" Oning", "", None, "thble ", "ONING"])
    hits = V.table(spark, sf, "documents").where(text.contains_any("text", words))
    return hits.agg(F.count(F.lit(1)).alias("posts"))
