"""Scoring frames of posts: expression form, table form, external scorers and provider answers."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StructField, StructType

from chatterscope.functions.lookup import is_small, join_method, literal_lookup
from chatterscope.functions.responses import parse_response
from chatterscope.functions.sentiment import (
    Rules,
    after_previous_word,
    contrast_weight,
    event_hit,
    is_negator,
    normalized,
    punctuation_emphasis,
    sentiment_label,
    toward,
)
from chatterscope.functions.text import provider_label, strip_ws
from chatterscope.functions.vocabulary import compound_by_vocabulary, distinct_words, pieces, word_hits
from chatterscope.operators.tagging import term_filter


def one_per_token(lexicon):
    return lexicon.groupBy("token").agg(F.min("valence").alias("valence"))


def lexicon_dict(lexicon, words=None):
    """A lexicon table as a dict, or None if it is measured as too large to be copied to the executors.

    Of a repeated token, the least valence counts, as in `score_by_join`. `words`, a frame of one column, restricts the
    table to some words before it is measured.
    """
    if isinstance(lexicon, dict):
        return lexicon
    table = one_per_token(lexicon)
    if words is not None:
        table = table.join(words.toDF("_word"), F.col("token") == F.col("_word"), "left_semi")
    return _collected(table) if is_small(table) else None


def _collected(table):
    return dict(zip(*(table.toArrow().column(c).to_pylist() for c in ("token", "valence"))))


def pandas_scorer(score_texts):
    """Wrap a function on a list of texts as a scorer; empty texts and failures score 0."""

    @pandas_udf("double")
    def scorer(texts: pd.Series) -> pd.Series:
        scores = pd.Series(0.0, index=texts.index)
        filled = texts.fillna("") != ""
        try:
            scores[filled] = [float(s) for s in score_texts(texts[filled].tolist())]
        except Exception:
            # A batch that fails is retried text by text, so that one bad text costs one score.
            for i in texts.index[filled]:
                try:
                    scores[i] = float(score_texts([texts[i]])[0])
                except Exception:
                    scores[i] = 0.0
        return scores

    return scorer


def with_labels(df):
    """Add the sentiment label and, for tagged posts, the event flag."""
    df = df.withColumn("sentiment", sentiment_label("compound"))
    if "event_tags" in df.columns:
        df = df.withColumn("event_hit", event_hit("event_tags"))
    return df


def score_posts(df, lexicon=None, rules=None, scorer=None, key="id", text="text"):
    """Add compound, sentiment and event_hit.

    `lexicon` is a dict or a table (token, valence). The distinct words of a batch of texts are looked up once. A table that is
    too large to be copied is joined on batches, by the unique `key`; on streams, the executors must hold
    it. `scorer` plugs in any function Column -> Column instead.
    """
    if scorer is not None:
        return with_labels(df.withColumn("compound", scorer(F.col(text))))
    words = lexicon_dict(lexicon)
    if words is None and not df.isStreaming:
        return with_labels(score_by_join(df, lexicon, rules, key, text))
    words = _collected(one_per_token(lexicon)) if words is None else words
    return with_labels(df.withColumn("compound", compound_by_vocabulary(text, words, rules)))


def word_rows(df, key, text, rules, tokens):
    """One row per word that may be one of `tokens` (a frame of one column), with its three predecessors, all that the rules look at.

    Words are passed over by a filter of fixed size, whatever the number of tokens; a few that are no tokens remain.
    """
    held = term_filter(tokens, tokens.columns[0])
    shared = df.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        held = shared.value
        for batch in batches:
            begin = 0
            for texts in pieces(batch.column(1)):
                keys = batch.column(0).slice(begin, len(texts))
                begin += len(texts)
                yield word_hits(keys, texts, rules, held.maybe if held else lambda words: np.zeros(len(words), bool))

    word = StructType().add("word", "string").add("capital", "boolean")
    schema = StructType([StructField("key", df.schema[key].dataType)]).add("place", "integer").add("cut", "integer")
    for back in range(4):
        schema = schema.add(f"w{back}", word)
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def score_by_join(df, lexicon, rules=None, key="id", text="text"):
    """The same score with the lexicon as a joined table, for lexicons of any size.

    One that is too large to be copied is joined with the distinct words of the texts first. If the words found are few enough to be
    copied, which they mostly are, texts are scored where they lie, and `key` does not matter.
    """
    rules = rules or Rules()
    if isinstance(lexicon, dict):
        lexicon = df.sparkSession.createDataFrame(list(lexicon.items()), "token string, valence double")
    known = lexicon_dict(lexicon)
    if known is None:
        known = lexicon_dict(lexicon, distinct_words(df, text))
    if known is not None:
        return df.withColumn("compound", compound_by_vocabulary(text, known, rules))
    return score_by_words(df, lexicon, rules, key, text)


def score_by_words(df, lexicon, rules=None, key="id", text="text"):
    """The same score with a row for each word, where even the words of the texts are too many to be copied.

    Only words found in the lexicon survive the first join; sums are formed per task before they
    are shuffled. `key` must be unique.
    """
    rules = rules or Rules()
    degree_of = literal_lookup(rules.degrees)
    lexicon = one_per_token(lexicon)
    method = join_method(lexicon)
    valences = lexicon.select(F.col("token").alias("word0"), "valence").hint(method)
    hits = word_rows(df, key, text, rules, lexicon.select("token")).join(valences, F.col("w0.word") == F.col("word0"))
    for back in (1, 2, 3):
        known = lexicon.select(
            F.col("token").alias(f"word{back}"), F.lit(True).alias(f"known{back}")
        ).hint(method)
        hits = hits.join(known, F.col(f"w{back}.word") == F.col(f"word{back}"), "left")
    valence = F.col("valence")
    value = valence + F.when(F.col("w0.capital"), toward(valence, rules.capitals)).otherwise(
        F.lit(0.0)
    )
    hits = hits.withColumn("value", value)
    for back, weight in enumerate(rules.distance, start=1):
        word = F.col(f"w{back}.word")
        moved = after_previous_word(
            F.col("value"),
            F.coalesce(F.col(f"known{back}"), F.lit(False)),
            F.col(f"w{back}.capital"),
            degree_of(word),
            is_negator(word, rules),
            weight,
            rules,
        )
        hits = hits.withColumn("value", F.when(word.isNull(), F.col("value")).otherwise(moved))
    is_degree = degree_of(F.col("w0.word")).isNotNull()
    share = F.when(is_degree, F.lit(0.0)).otherwise(
        F.col("value") * contrast_weight(F.col("place"), F.col("cut"), rules)
    )
    sums = hits.groupBy("key").agg(F.sum(share).alias("valence_sum"))
    body = F.coalesce(F.col(text), F.lit(""))
    score = normalized(
        F.coalesce(F.col("valence_sum"), F.lit(0.0)), punctuation_emphasis(body, rules), rules
    )
    return (
        df.join(
            sums.withColumnRenamed("key", "sum_key"),
            F.col(key).eqNullSafe(F.col("sum_key")),
            "left",
        )
        .withColumn("compound", score)
        .drop("sum_key", "valence_sum")
    )


def with_provider(df, provider, lexicon, rules=None, response="response", text="text"):
    """Score, relevancy, explanation and raw answer of a live row.

    With the remote provider the answer is read from the `response` column; rows without text or
    answer fall back to the lexicon score and have no relevancy.
    """
    words = lexicon_dict(lexicon)
    words = _collected(one_per_token(lexicon)) if words is None else words
    fallback = compound_by_vocabulary(text, words, rules)
    nothing = F.lit(None)
    if provider != "gemini":
        return df.withColumn("compound", fallback)
    answered = (F.coalesce(F.col(text), F.lit("")) != "") & F.col(response).isNotNull()
    parsed = df.withColumn("_parsed", F.when(answered, parse_response(F.col(response))))
    return parsed.withColumns(
        {
            "compound": F.when(answered, F.col("_parsed.compound")).otherwise(fallback),
            "relevancy": F.col("_parsed.relevancy"),
            "explanation": F.col("_parsed.explanation"),
            "raw": F.when(answered, strip_ws(response)).otherwise(nothing),
        }
    ).drop("_parsed")


def live_rows(df, provider, lexicon, rules=None, response="response", text="text"):
    """Rows of the live view, with the same columns for both providers: sent_provider, compound, relevancy,
    gemini_raw and gemini_explanation (nulls where the lexicon scored).
    """
    scored = with_provider(df, provider, lexicon, rules, response, text)
    remote = provider == "gemini"
    nothing = F.lit(None).cast("string")
    scored = scored.withColumns(
        {
            "sent_provider": provider_label(provider),
            "relevancy": F.col("relevancy") if remote else F.lit(None).cast("double"),
            "gemini_raw": F.col("raw") if remote else nothing,
            "gemini_explanation": F.col("explanation") if remote else nothing,
        }
    )
    return scored.drop("raw", "explanation") if remote else scored
