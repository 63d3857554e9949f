"""Benchmark decontamination: windows of benchmark words, looked up at every place of every document."""

import math

from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import ascii_lower, keep, split_words, text_mark, without

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

# The window table is copied to all executors in parts of at most this many bytes; each part is one scan.
COPY_BYTES = 48 << 20


def words_of(text="text"):
    return split_words(ascii_lower(F.col(text)), SEPARATORS)


def window_hash(words, at, length):
    """Hash of `length` words from place `at`; reads the array in place, so it stays in compiled code."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(length)])


def item_windows(items: DataFrame, size=WINDOW) -> DataFrame:
    """window array<string>, length, items array<long> (sorted) of benchmark(item_id, text).

    An item of fewer than `size` words is one window; one without words (null text) has none. Repeated windows
    are one row. Null ids mark words as hit, but are not listed.
    """
    words = items.select("item_id", words_of().alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("at"))
        .groupBy(F.slice("words", F.col("at") + 1, size).alias("window"))
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumn("length", F.size("window"))
    )


def scan(docs: DataFrame, items: DataFrame, size=WINDOW, copy_bytes=COPY_BYTES) -> DataFrame:
    """doc_id, mark, n_words, hits array<struct<at,length>> (verified, sorted), items array<long>; one row per
    row of docs(doc_id, text).

    Every place of a document is hashed with the words that follow it, looked up in the copied window table and
    compared word by word. The table is cut into parts of at most `copy_bytes`; each part is one more scan.
    Null or empty texts have no words and no hits. Repeated rows stay repeated.
    """
    windows = keep(item_windows(items, size), "windows")
    sizes = windows.select(
        "length", (F.octet_length(F.concat_ws(" ", "window")) + 8 * F.size("items") + 64).alias("bytes")
    ).groupBy("length").agg(F.sum("bytes").alias("bytes")).collect()  # a row for each of at most `size` lengths
    lengths = sorted(r["length"] for r in sizes) or [size]
    parts = max(1, math.ceil(sum(r["bytes"] for r in sizes) / copy_bytes))
    window_key = F.when(F.lit(False), F.lit(0))
    for n in lengths:
        window_key = window_key.when(F.col("length") == n, window_hash(F.col("window"), F.lit(0), n))
    windows = windows.withColumn("key", window_key)

    read = docs.select("doc_id", text_mark().alias("mark"), words_of().alias("words"))
    # One more, empty place per document carries its number of words, so that no second pass is needed.
    places = F.posexplode(F.concat("words", F.array(F.lit(None).cast("string"))))
    read = read.select("doc_id", "mark", "words", places.alias("at", "word"))
    n_words = F.size("words")
    if len(lengths) == 1:
        at = read.withColumn("n", F.lit(lengths[0])).withColumn(
            "key", F.when(F.col("at") + F.col("n") <= n_words, window_hash(F.col("words"), F.col("at"), lengths[0]))
        )
    else:
        keys = [
            F.struct(
                F.lit(n).alias("n"),
                F.when(F.col("at") + n <= n_words, window_hash(F.col("words"), F.col("at"), n)).alias("key"),
            )
            for n in lengths
        ]
        at = read.select("*", F.explode(F.array(*keys)).alias("k")).select("*", "k.n", "k.key")

    found = None
    for part in range(parts):
        mine = windows if parts == 1 else windows.where(F.pmod("key", F.lit(parts)) == part)
        mine = F.broadcast(mine.select(F.col("key").alias("w_key"), "length", "window", "items"))
        same = (
            (F.col("key") == F.col("w_key"))
            & (F.col("n") == F.col("length"))
            & (F.slice("words", F.col("at") + 1, F.col("n")) == F.col("window"))
        )
        last = (F.col("at") == n_words) & (F.col("n") == lengths[0]) & F.lit(part == 0)
        rows = (
            at.join(mine, same, "left")
            .where(F.col("w_key").isNotNull() | last)
            .select(
                "doc_id", "mark", n_words.alias("n_words"),
                last.cast("int").alias("row"),
                F.when(F.col("w_key").isNotNull(), F.struct("at", "length")).alias("hit"),
                "items",
            )
        )
        found = rows if found is None else found.unionByName(rows)
    return (
        found.groupBy("doc_id", "mark")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum("row").alias("rows"),
            F.array_sort(F.collect_set("hit")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .withColumn("_", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .drop("rows", "_")
    )


def hit_words(hits="hits"):
    """Number of words inside any hit."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))

    def add(acc, hit):
        end = F.greatest(acc["end"], hit["at"] + hit["length"])
        return F.struct((acc["words"] + end - F.greatest(acc["end"], hit["at"])).alias("words"), end.alias("end"))

    return F.aggregate(hits, start, add, lambda acc: acc["words"].cast("long"))


def contamination(docs: DataFrame, items: DataFrame, size=WINDOW, copy_bytes=COPY_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of docs; see `scan`."""
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return (
        scan(docs, items, size, copy_bytes)
        .withColumn("n_hit", hit_words())
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(ids, 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size=WINDOW) -> DataFrame:
    """docs without the documents that contain a window; all columns stay, clean documents are untouched."""
    hit = keep(scan(docs, items, size).where(F.size("hits") > 0).select("doc_id", "mark").distinct(), "leaks")
    return without(docs, hit)


def remove_spans(docs: DataFrame, items: DataFrame, size=WINDOW) -> DataFrame:
    """doc_id, mark, text as words outside hits, joined by single spaces; for documents with hits only."""
    hit = scan(docs, items, size).where(F.size("hits") > 0).select("doc_id", "mark", "hits").distinct()
    read = docs.select("doc_id", text_mark().alias("mark"), words_of().alias("words"))
    outside = F.filter(
        "words", lambda w, i: ~F.exists("hits", lambda h: (i >= h["at"]) & (i < h["at"] + h["length"]))
    )
    here, there = read.alias("here"), hit.alias("there")
    same = F.col("here.doc_id").eqNullSafe(F.col("there.doc_id")) & (F.col("here.mark") == F.col("there.mark"))
    return here.join(there, same).select("here.doc_id", "here.mark", "words", "hits").select(
        "doc_id", "mark", F.concat_ws(" ", outside).alias("text")
    )
