"""Inputs of the checks, derived from the given tables."""

from pyspark.sql import functions as F

from chatterscope.config import parse_config
from chatterscope.functions.sentiment import Rules
from chatterscope.session import pin_utc

# The documents are invented words, so brands, events and sentiment words are such words, too.
CONFIG = parse_config(
    {
        "brands": [
            {"name": "First", "canonical": "src1", "keywords": ["oning", "thble"],
             "events": ["ingre", "onnd"]},
            {"name": "Second", "canonical": "src2", "keywords": ["mentre", "license"],
             "events": ["tion"]},
            {"name": "Gamma", "keywords": ["ingre"], "events": ["zzznone"]},
        ],
        "global_events": ["@"],
        "subreddits": ["src1", "src12", "Src2", "src3"],
    }
)

LEXICON = {
    "thth": 2.1, "onon": -1.7, "erre": -2.4, "anea": 1.3, "ing": -0.9, "es": 0.4, "attion": 1.9,
    "annt": -2.2, "hent": 1.2, "oument": 2.3, "letre": -1.2, "erlich": 1.6, "einch": -1.5,
    "las": 0.8, "ue": -0.7,
}

RULES = Rules(
    degrees={"thly": 0.293, "at": 0.293, "la": 0.293, "mit": -0.293, "it": -0.293},
    negators=("thnt", "an", "è", "a"),
    contrast="thin",
)

# Fixed clocks, so that results can be compared.
NOW = 1_710_000_000


def table(spark, sf, name):
    """A given table. Files with fewer splits than there are cores are spread over the cores."""
    pin_utc(spark)
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def posts(spark, sf):
    """Documents as posts, with ties, nulls and a newer copy of every tenth one."""
    doc = F.col("doc_id")
    created = 1704067200 + (doc * 79193) % 5184000
    copies = F.when(doc % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    link = F.concat(F.lit("https://example.org/p/"), doc.cast("string"))
    score = F.when(doc % 17 != 0, ((doc * 37) % 31 + F.col("copy")).cast("int"))
    return (
        table(spark, sf, "documents")
        .select("doc_id", "text", "source", F.explode(copies).alias("copy"))
        .select(
            doc.cast("string").alias("id"),
            F.when(doc % 2 == 0, "submission").otherwise("comment").alias("type"),
            F.col("source").alias("subreddit"),
            F.concat(F.lit("u"), (doc % 25).cast("string")).alias("author"),
            created.alias("created_utc"),
            "text",
            link.alias("url"),
            score.alias("score"),
            F.when(doc % 2 == 0, ((doc * 13) % 50).cast("int")).alias("num_comments"),
            F.when(doc % 2 == 1, F.concat(F.lit("t3_"), (doc - 1).cast("string"))).alias("parent_id"),
            F.lit(None).cast("string").alias("brand"),
            (created + 60 + doc % 300 + F.col("copy") * 3600).alias("fetched_at"),
            F.when(doc % 5 == 0, F.lit(None))
            .when(doc % 3 == 0, link)
            .otherwise(F.concat(F.lit("/p/"), doc.cast("string")))
            .alias("permalink"),
        )
    )


def submissions(spark, sf):
    """Documents as raw submissions; some lack an author, a score or a body."""
    doc = F.col("doc_id")
    name = F.concat(F.lit("u"), (doc % 25).cast("string"))
    return table(spark, sf, "documents").select(
        doc.cast("string").alias("id"),
        F.col("source").alias("subreddit"),
        F.when(doc % 7 != 0, F.struct(name.alias("name"))).alias("author"),
        F.when(doc % 11 != 0, 1704067200 + (doc * 79193) % 5184000).alias("created_utc"),
        F.concat(F.lit(" "), F.col("source"), F.lit(" "), doc.cast("string")).alias("title"),
        F.when(doc % 6 != 0, F.col("text")).alias("selftext"),
        F.concat(F.lit("/p/"), doc.cast("string")).alias("permalink"),
        F.when(doc % 17 != 0, (doc * 37) % 31).alias("score"),
        F.when(doc % 13 != 0, (doc * 13) % 50).alias("num_comments"),
    )


def comments(spark, sf):
    """Conversation turns as raw comments."""
    conv, turn = F.col("conv_id"), F.col("turn")
    key = F.concat(conv.cast("string"), F.lit("-"), turn.cast("string"))
    return table(spark, sf, "conversations").select(
        key.alias("id"),
        F.col("role").alias("subreddit"),
        F.when(turn % 3 != 0, F.struct(F.col("role").alias("name"))).alias("author"),
        (1704067200 + conv * 60 + turn).alias("created_utc"),
        F.when(turn % 5 != 4, F.col("text")).alias("body"),
        F.concat(F.lit("/c/"), key).alias("permalink"),
        F.when(conv % 4 != 0, (conv * 7 + turn) % 19).alias("score"),
        F.concat(F.lit("t3_"), conv.cast("string")).alias("parent_id"),
    )


def scored_events(spark, sf):
    """Events as scored posts: type as brand, value scaled to [-1, 1]."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_type").alias("brand"),
        F.round(F.least(F.lit(1.0), F.col("value") / 250 - 1), 4).alias("compound"),
    )


def responses(spark, sf):
    """Events as answers of a remote model, from clean JSON to free text and nothing."""
    kind, value = F.col("event_id") % 7, F.col("value").cast("string")
    score, rating = F.col("event_id") % 201 - 100, F.col("event_id") % 100

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    answer = (
        F.when(kind == 0, text('{"compound": ', score / 100, ', "relevancy": ', rating / 100,
                               ', "explanation": "', F.col("event_type"), '"}'))
        .when(kind == 1, text('{"compound": ', value, ', "relevancy": -', value, "}"))
        .when(kind == 2, text("Compound : ", score / 100, ", RELEVANCY = ", rating / 100))
        .when(kind == 3, text('{"compound": ', score / 100, ', "relevancy": "high"}'))
        .when(kind == 4, F.lit(None))
        .when(kind == 5, F.lit("cannot tell"))
        .otherwise(text('  {"relevancy": null, "explanation": "', F.col("event_type"), '"} '))
    )
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.lit("onon thth thth").alias("text"), answer.alias("response")
    )
