"""Which brands and events a post mentions."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from chatterscope.config import config_frames
from chatterscope.functions.lookup import (
    MAX_LITERAL_ENTRIES,
    is_small,
    join_method,
    literal_lookup,
)
from chatterscope.functions.terms import TermFilter, TermIndex, filter_slots, stretch_texts, text_bytes, text_parts
from chatterscope.functions.text import brand_hit, lower_contains_any
from chatterscope.session import scratch_path

# Bits of the filter of the join form, as powers of two: 16 for each term, within these limits.
_LEAST_BITS, _MOST_BITS = 16, 27
_NO_STRETCH = pa.table({"row": pa.array([], pa.int64()), "span": pa.array([], pa.string())})


class KeywordTables(NamedTuple):
    """What to look for, as tables of any size instead of a configuration.

    keywords: position, canonical, keyword; events: position, event; hints: subreddit, canonical,
    position. Positions give the order in which names are reported.
    """

    keywords: DataFrame
    events: DataFrame | None = None
    hints: DataFrame | None = None


def term_filter(terms, term):
    """A TermFilter of a table of terms, made by its tasks; None if there are none."""
    terms = terms.select(F.col(term).alias("term")).where(F.octet_length("term") > 0)
    rows, lengths = terms.agg(F.count(F.lit(1)), F.collect_set(F.octet_length("term"))).first()
    if not rows:
        return None
    bits = max(_LEAST_BITS, min(_MOST_BITS, (16 * rows).bit_length()))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(filter_slots(batch.column(0), bits))], ["slot"])

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    slots = terms.mapInArrow(run, "slot long")
    held = slots.groupBy(F.shiftright("slot", 6).alias("place")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[held.column("place").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)
    return TermFilter(words, lengths)


def substring_join(left, key, text, terms, term):
    """Pairs of left rows and term rows where the text contains the term.

    An equi-join instead of a nested loop: the stretches of a text that may be terms, by a filter of fixed size that every
    executor holds, are joined with the terms. Little else than what is found is shuffled, both sides may be large, and frequent
    keys can be split by adaptive execution. `terms` must be lowercase and non-empty; returns key, and all columns of
    `terms`, distinct. Rows of one key must have one text.
    """
    held = term_filter(terms, term)
    if held is None:
        nothing = StructType([left.schema[key], *terms.schema.fields])
        return left.sparkSession.createDataFrame([], nothing)
    shared = left.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("array<string>")
    def stretches(texts: pa.Array) -> pa.Array:
        offsets, data = text_bytes(texts)
        parts = [_NO_STRETCH]
        for i, j in text_parts(offsets):
            row, begin, end = shared.value.find(offsets[i : j + 1], data)
            found = pa.table({"row": row + i, "span": stretch_texts(data, begin, end)})
            parts.append(found.group_by(["row", "span"], use_threads=False).aggregate([]).sort_by("row"))
        found = pa.concat_tables(parts).combine_chunks()
        ends = np.searchsorted(found.column("row").to_numpy(), np.arange(len(texts) + 1))
        spans = pa.concat_arrays([pa.array([], pa.string()), *found.column("span").chunks])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)

    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    spans = left.select(F.col(key), F.explode(stretches(lowered)).alias("_span"))
    pairs = spans.join(terms.hint(join_method(terms)), F.col("_span") == F.col(term))
    return pairs.select(key, *terms.columns).distinct()


def _found_by_index(df, name, terms, value, text):
    """By an index of all terms at every executor, in one pass over each batch of texts."""
    held = terms.toArrow()  # measured: see is_small
    position, names = held.column("position").to_pylist(), held.column(value).to_pylist()
    order = {pair: i for i, pair in enumerate(sorted(set(zip(position, names))))}
    ranks = np.array([order[pair] for pair in zip(position, names)], np.int64)
    values = pa.array([n for _, n in order], pa.string())
    index = TermIndex(held.column("term").to_pylist())
    shared = df.sparkSession.sparkContext.broadcast((index, ranks, values))

    @F.arrow_udf("array<string>")
    def lookup(texts: pa.Array) -> pa.Array:
        index, ranks, values = shared.value
        row, term = index.find(*text_bytes(texts))
        pairs = np.unique((row << 32) | ranks[term])
        ends = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(pa.array(pairs & 0xFFFFFFFF)))

    return df.withColumn(name, F.array_distinct(lookup(F.lower(F.coalesce(F.col(text), F.lit(""))))))


def _found_by_join(df, name, terms, value, text):
    """By a join; rows meet their names again by a mark of the text, so ids do not matter."""
    marked = df.withColumn("_mark", F.md5(F.lower(F.coalesce(F.col(text), F.lit("")))))
    pairs = substring_join(marked.select("_mark", text), "_mark", text, terms, "term")
    found = pairs.groupBy(F.col("_mark").alias("_key")).agg(
        F.array_sort(F.collect_set(F.struct("position", value))).alias("_found")
    )
    names = F.coalesce(F.array_distinct(F.col(f"_found.{value}")), F.array().cast("array<string>"))
    joined = marked.join(found, F.col("_mark") == F.col("_key"), "left").withColumn(name, names)
    return joined.drop("_mark", "_key", "_found")


def found_terms(df, name, terms, term, value, text="text", method=None):
    """Add `name`: the values of the rows of `terms` (position, term, value) whose term is in the text.

    Case does not matter; empty terms and null texts match nothing. Values come in order of position,
    each once. A row of df gives a row, whatever its id. Tables that are measured as small (see
    `is_small`) become an index that is copied to the executors, which also works on streams; on
    batches, larger ones are joined. `method` (index, join) decides instead.
    """
    known = terms.select("position", F.col(value), F.lower(term).alias("term"))
    known = known.where(F.col("term") != "").distinct()
    if value == term:
        known = known.withColumn(value, F.col("term"))
    if method is None:
        method = "index" if df.isStreaming or is_small(known) else "join"
        if method == "join":
            # Read several times, so worked out once.
            path = scratch_path(df.sparkSession, "terms")
            known.write.parquet(path)
            known = df.sparkSession.read.schema(known.schema).parquet(path)
    return {"index": _found_by_index, "join": _found_by_join}[method](df, name, known, value, text)


def subreddit_hints(brand_dim, sub_dim):
    """Pairs (subreddit, canonical) where the name of the community contains the brand."""
    subs = sub_dim.select(F.lower(F.trim("subreddit")).alias("subreddit")).distinct()
    brands = brand_dim.select("position", F.lower("canonical").alias("canonical"))
    pairs = substring_join(subs, "subreddit", "subreddit", brands, "canonical")
    return pairs.select("subreddit", "canonical", "position")


def hints_of(cfg):
    """The same pairs for a configuration, as a dict community -> canonical names."""
    hints = {}
    for sub in dict.fromkeys(s.strip().lower() for s in cfg.subreddits):
        names = [b.canonical for b in cfg.brands if b.canonical in sub]
        if names:
            hints[sub] = list(dict.fromkeys(names))
    return hints


def _found(tests):
    """Names whose test holds, in order. Free of lambdas, which would keep the text tests from being
    compiled and from sharing the lowercase text.
    """
    names = [F.when(test, F.lit(name)).otherwise(F.lit("")) for name, test in tests]
    return F.array_remove(F.array(*names), "") if names else F.array().cast("array<string>")


def brands_in_text(lowered, cfg):
    """Canonical names whose keywords occur in the lowercase text, in configuration order."""
    words = [(b.canonical, [k.lower() for k in b.keywords if k]) for b in cfg.brands]
    return F.array_distinct(_found([(b, lower_contains_any(lowered, ks)) for b, ks in words]))


def events_in_text(lowered, cfg):
    """Event words of any brand and global ones; not tied to the brands that matched."""
    return _found([(e, F.contains(lowered, F.lit(e))) for e in cfg.event_words])


def match_brands(df, cfg, mode="native"):
    """Add `brands`. `native` tests every keyword in one pass, `join` uses a keyword table."""
    if mode == "native":
        text = F.lower(F.coalesce(F.col("text"), F.lit("")))
        return df.withColumn("brands", brands_in_text(text, cfg))
    return match_terms(df, config_frames(df.sparkSession, cfg)["keyword_dim"])


def match_terms(df, terms, method=None):
    """Add `brands` from a keyword table (position, canonical, keyword) of any size."""
    return found_terms(df, "brands", terms, "keyword", "canonical", method=method)


def match_events(df, cfg, mode="native"):
    """Add `event_tags`, in the same two forms."""
    if mode == "native":
        text = F.lower(F.coalesce(F.col("text"), F.lit("")))
        return df.withColumn("event_tags", events_in_text(text, cfg))
    return match_event_terms(df, config_frames(df.sparkSession, cfg)["event_dim"])


def match_event_terms(df, events, method=None):
    """Add `event_tags` from a table (position, event) of any size."""
    return found_terms(df, "event_tags", events, "event", "event", method=method)


def add_hints(df, hints):
    """Add the brands hinted at by the community. `hints` is a dict, or a table of pairs."""
    empty = F.array().cast("array<string>")
    sub = F.lower(F.coalesce(F.col("subreddit"), F.lit("")))
    if isinstance(hints, dict) and len(hints) <= MAX_LITERAL_ENTRIES:
        hinted = literal_lookup(hints, "array<string>")(sub)
        return df.withColumn("brands", F.array_union("brands", F.coalesce(hinted, empty)))
    if isinstance(hints, dict):
        rows = [(s, b, i) for s, names in hints.items() for i, b in enumerate(names)]
        hints = df.sparkSession.createDataFrame(
            rows, "subreddit string, canonical string, position int"
        )
    grouped = hints.groupBy(F.col("subreddit").alias("_sub")).agg(
        F.array_sort(F.collect_set(F.struct("position", "canonical"))).alias("_hinted")
    )
    return (
        df.join(grouped, sub == F.col("_sub"), "left")
        .withColumn(
            "brands", F.array_union("brands", F.coalesce(F.col("_hinted.canonical"), empty))
        )
        .drop("_sub", "_hinted")
    )


def tag_posts(df, cfg=None, tables=None):
    """Add `brands` and `event_tags` to each post: from a configuration, or from KeywordTables."""
    if tables is None:
        return add_hints(match_events(match_brands(df, cfg), cfg), hints_of(cfg))
    tagged = match_terms(df, tables.keywords)
    if tables.events is None:
        tagged = tagged.withColumn("event_tags", F.array().cast("array<string>"))
    else:
        tagged = match_event_terms(tagged, tables.events)
    return tagged if tables.hints is None else add_hints(tagged, tables.hints)


def has_brand(df):
    return df.where(F.size("brands") > 0)


def explode_brands(df):
    """One row per post and brand; replaces the brand the post arrived with."""
    return has_brand(df).withColumn("brand", F.explode("brands")).drop("brands")


def extract_brand(df, keywords, text="text"):
    """Keep rows with a whole keyword and note the leftmost one, lowercased, as `brand`."""
    return df.withColumn("brand", brand_hit(text, keywords)).where(F.col("brand") != "")
