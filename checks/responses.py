"""Checks of reading and filtering the answers of a remote model."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks import views as V
from checks.registry import query
from chatterscope.functions.responses import parse_response, parse_response_fallback
from chatterscope.operators import live, scoring

# What each kind of answer must give, from the numbers that went into it.
_READ = """answers AS (
  SELECT event_id, event_id % 7 AS kind, event_type, value,
    (event_id % 201 - 100) / 100e0 AS s, (event_id % 100) / 100e0 AS r FROM events),
read AS (
  SELECT event_id, kind,
    CASE kind WHEN 0 THEN s WHEN 1 THEN least(1e0, value) WHEN 2 THEN s WHEN 3 THEN s
      WHEN 4 THEN NULL ELSE 0e0 END AS compound,
    CASE kind WHEN 0 THEN r WHEN 1 THEN 0e0 WHEN 2 THEN r END AS relevancy,
    CASE WHEN kind IN (0, 6) THEN event_type END AS explanation
  FROM answers)"""


@query("x3_parse_response", O.select(_READ, "SELECT event_id, compound, relevancy, explanation FROM read"))
def parse(spark, sf):
    return (
        V.responses(spark, sf)
        .withColumn("r", parse_response("response"))
        .select("event_id", "r.compound", "r.relevancy", "r.explanation")
    )


@query(
    "x4_parse_response_fallback",
    O.select(_READ, """SELECT event_id, CASE WHEN kind = 2 THEN s END AS compound,
    CASE WHEN kind = 2 THEN r END AS relevancy FROM answers"""),
)
def parse_fallback(spark, sf):
    return (
        V.responses(spark, sf)
        .withColumn("r", parse_response_fallback("response"))
        .select("event_id", "r.compound", "r.relevancy")
    )


# The text of these rows is `onon thth thth`, so the fallback score is that of -1.7 + 2.1 + 2.1.
_FALLBACK = "round(2.5e0 / sqrt(2.5e0 * 2.5e0 + 15e0), 4)"


@query(
    "x5_with_provider",
    O.select(_READ, f"""SELECT event_id, coalesce(compound, {_FALLBACK}) AS compound, relevancy,
    explanation, kind <> 4 AS answered FROM read"""),
)
def provider(spark, sf):
    frame = scoring.with_provider(V.responses(spark, sf), "gemini", V.LEXICON, V.RULES)
    return frame.select(
        "event_id", "compound", "relevancy", "explanation", F.col("raw").isNotNull().alias("answered")
    )


@query(
    "f8_filter_relevancy",
    O.select(_READ, "SELECT event_id FROM read WHERE coalesce(relevancy, 0) >= 0.5"),
)
def filter_relevancy(spark, sf):
    rated = V.responses(spark, sf).select("event_id", parse_response("response")["relevancy"].alias("relevancy"))
    return live.filter_relevancy(rated, 0.5).select("event_id")


@query(
    "f9_dropped_count",
    O.select(_READ, "SELECT count(*) AS dropped FROM read WHERE coalesce(relevancy, 0) < 0.5"),
)
def dropped_count(spark, sf):
    rated = V.responses(spark, sf).select(parse_response("response")["relevancy"].alias("relevancy"))
    return live.dropped_count(rated, 0.5)
