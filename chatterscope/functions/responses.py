"""Reading the JSON or near-JSON answers of a remote sentiment model."""

from pyspark.sql import functions as F

from chatterscope.functions.lookup import bind
from chatterscope.functions.text import _col, strip_ws
from chatterscope.functions.times import number_or_null

# The fallback patterns for answers that are not valid JSON.
COMPOUND_PATTERN = r"(?i)compound\s*[:=]\s*(-?\d+\.\d+|-?\d+)"
RELEVANCY_PATTERN = r"(?i)relevancy\s*[:=]\s*(\d*\.?\d+)"


def clamp(c, lo, hi):
    """Limit to [lo, hi]; null stays null (greatest and least would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def parse_response_fallback(c):
    """Struct (compound, relevancy) found by pattern in free text; null where not found."""
    c = _col(c)

    def found(pattern):
        return F.regexp_extract(c, pattern, 1).try_cast("double")

    return F.struct(
        found(COMPOUND_PATTERN).alias("compound"), found(RELEVANCY_PATTERN).alias("relevancy")
    )


def _field(answer, name):
    """Type and text of a field of the only object of an array; the type is null where the field is missing."""
    path = f"$[0].{name}"
    return F.struct(
        F.schema_of_variant(F.try_variant_get(answer, path, "variant")).alias("type"),
        F.try_variant_get(answer, path, "string").alias("shown"),
    )


def _number(field):
    """A JSON value as double: numbers, spelled numbers and booleans; else null."""
    truth = F.when(field["shown"] == "true", F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(field["type"] == "BOOLEAN", truth).otherwise(number_or_null(field["shown"]))


def parse_response(c):
    """Struct (compound, relevancy, explanation) of a model answer.

    A valid object gives its fields; compound defaults to 0. One unreadable field sends the whole
    answer to the pattern search, except that a compound read before the failure is kept. An object
    that holds a key twice is not valid. The JSON is parsed once, and patterns are searched only
    where it gave no clean result.
    """

    def read(answer):
        # In brackets, text after the object makes the whole invalid, or one element too many.
        whole = F.try_parse_json(F.concat(F.lit("["), answer, F.lit("]")))
        return F.when(F.startswith(answer, F.lit("{")), bind(whole, fields))

    def fields(whole):
        single = F.try_variant_get(whole, "$[1]", "variant").isNull()
        return F.when(
            whole.isNotNull() & single,
            F.struct(
                _field(whole, "compound").alias("compound"),
                _field(whole, "relevancy").alias("relevancy"),
                F.try_variant_get(whole, "$[0].explanation", "string").alias("explanation"),
            ),
        )

    def numbers(said):
        given = F.when(said["compound"]["type"].isNull(), F.lit(0.0)).otherwise(_number(said["compound"]))
        return F.when(
            said.isNotNull(),
            F.struct(
                given.alias("compound"),
                _number(said["relevancy"]).alias("relevancy"),
                said["explanation"].alias("explanation"),
                said["relevancy"]["shown"].isNull().alias("unrated"),
            ),
        )

    def choose(answer, said):
        clean = said["compound"].isNotNull() & (said["unrated"] | said["relevancy"].isNotNull())
        kept = F.struct(*[said[name].alias(name) for name in ("compound", "relevancy", "explanation")])
        searched = bind(
            parse_response_fallback(answer),
            lambda loose: F.struct(
                F.coalesce(loose["compound"], said["compound"], F.lit(0.0)).alias("compound"),
                loose["relevancy"].alias("relevancy"),
                F.lit(None).cast("string").alias("explanation"),
            ),
        )
        return F.when(clean, kept).otherwise(searched)

    def limited(r):
        return F.struct(
            clamp(r["compound"], -1.0, 1.0).alias("compound"),
            clamp(r["relevancy"], 0.0, 1.0).alias("relevancy"),
            r["explanation"].alias("explanation"),
        )

    # Each step is a variable, so that an answer is parsed once and not for every use of its parts.
    def parsed(answer):
        return bind(bind(read(answer), numbers), lambda said: choose(answer, said))

    found = bind(strip_ws(c), lambda answer: F.when(answer.isNotNull(), parsed(answer)))
    return bind(found, lambda r: F.when(r.isNotNull(), limited(r)))
