"""N-gram Jaccard join by vertical partitioning.

The sets of word 5-grams of all texts are cut into fragments of the global (hash) order of n-grams. Overlaps are
counted in each fragment on its own and summed:

1. Texts with equal sets become one class (a sum hash of 128 bits), so copies cost one member.
2. Support. For every class, the n-grams below a threshold of the order are counted by fragments: those that any
   other class has, too. A class that lacks more of them than a partner may lack cannot have a link. This leaves
   out nearly all texts and drops no link.
3. Candidates share one of the first n - ceil(0.8 n) + 1 n-grams in an order that puts rare ones first. Classes that
   meet in long lists are put into blocks of up to about 128, so that a large group of near copies gives pairs of
   blocks, not of texts.
4. For each pair of blocks, each fragment gives a matrix of partial overlaps; their sum is compared with the
   threshold. Out come the number of links of each class and the links of a spanning forest.
5. Components of the links.

Hashes of n-grams have 64 bits; equal hashes count as equal n-grams.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chatterscope.llm.common import bounded_batches, copied_if_small, keep, text_mark, without
from chatterscope.llm.components import components
from chatterscope.llm.hashing import byte_mask, gathered, mixed, sliced, text_bytes, windows, word_hashes

SEPARATORS = byte_mask((0x20, 0x20), (0x09, 0x0D))
WORDS = 5
PERCENT = 80

# Share of the global order whose n-grams take part in the support count.
SUPPORT_SHARE = 0.4
SUPPORT_LIMIT = np.uint64(int(SUPPORT_SHARE * 2**64))
FRAGMENT_TOKENS = 1_000_000
LIST = 16  # members of a list from which on they are put into blocks
BLOCK = 128
FRAGMENTS = 4  # of the verification
CELLS = 1_000_000  # of the matrices of one task
ORDER_ROWS = 1_000_000  # n-grams whose frequency is sent to the executors; the order of the others is their hash


def spare(n, percent=PERCENT):
    """How many n-grams of a set of n a partner may lack."""
    return n - -(-n * percent // 100)


def token_sets(batch, words=WORDS):
    """(index of row, sorted distinct n-gram hashes) of the rows of a batch that have words."""
    offsets, data = text_bytes(batch.column("text"))
    for i, hashes in word_hashes(offsets, data, SEPARATORS):
        if len(hashes):
            yield i, np.unique(windows(hashes, words))


def set_hash(tokens):
    """16 bytes that depend on the set alone."""
    return mixed(tokens).sum().tobytes() + mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().tobytes()


def short(mark):
    """A 64-bit key of a mark, for counting only."""
    return int.from_bytes(mark[:8], "little", signed=True)


def _members(docs, words):
    def run(batches):
        for batch in sliced(batches):
            n, low, keys = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            marks = [None] * batch.num_rows
            for i, tokens in token_sets(batch, words):
                n[i], low[i], marks[i] = len(tokens), np.searchsorted(tokens, SUPPORT_LIMIT), set_hash(tokens)
                keys[i] = short(marks[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_mark"), pa.array(n), pa.array(low),
                 pa.array(marks, pa.binary()), pa.array(keys)],
                ["doc_id", "text_mark", "n", "low", "mark", "key"],
            )

    read = docs.select("doc_id", "text", text_mark().alias("text_mark"))
    return read.mapInArrow(run, "doc_id long, text_mark long, n long, low long, mark binary, key long")


def _support(docs, words, fragments):
    """key (the first 8 bytes of a mark), support: n-grams in the supported share of the order that another has, too."""

    def cut(batches):
        scale = fragments / float(SUPPORT_LIMIT)
        for batch in gathered(batches, 12 << 20):
            sets = {}
            for _, tokens in token_sets(batch, words):
                low = tokens[: np.searchsorted(tokens, SUPPORT_LIMIT)]
                sets.setdefault(short(set_hash(tokens)), low)
            keys = np.fromiter(sets, np.int64, len(sets))
            sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
            tokens = np.concatenate([*sets.values(), np.zeros(0, np.uint64)])
            owner = np.repeat(np.arange(len(keys)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            same = np.zeros(len(tokens) + 1, bool)
            same[1:-1] = tokens[1:] == tokens[:-1]
            shared = same[:-1] | same[1:]
            rows = []
            # What is shared inside the batch is settled here; the rest of the world gets one nameless copy.
            settled = np.bincount(owner[shared], minlength=len(keys))
            some = np.nonzero(settled)[0]
            home = int(abs(int(keys[0]))) % fragments if len(keys) else 0
            rows.append((home, keys[some].tobytes(), settled[some].astype(np.int32).tobytes(), b"", True))
            once = ~same[:-1]
            tokens, owner = tokens[once], np.where(shared, -1, owner)[once]
            place = np.minimum((tokens.astype(np.float64) * scale).astype(np.int64), fragments - 1)
            cuts = np.searchsorted(place, np.arange(fragments + 1))
            for f in range(fragments):
                t, o = tokens[cuts[f] : cuts[f + 1]], owner[cuts[f] : cuts[f + 1]]
                if not len(t):
                    continue
                by = np.argsort(o, kind="stable")
                who, counts = np.unique(o, return_counts=True)
                named = np.where(who < 0, 0, keys[np.maximum(who, 0)])
                rows.append((f, named.tobytes(), counts.astype(np.int32).tobytes(), t[by].tobytes(), False))
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=["fragment", "keys", "counts", "tokens", "settled"]).astype(
                    {"fragment": "int32"}), preserve_index=False)

    def count(pdf):
        keys = [np.frombuffer(k, np.int64) for k in pdf["keys"]]
        counts = [np.frombuffer(c, np.int32) for c in pdf["counts"]]
        done = pdf["settled"].to_numpy()
        open_keys = np.concatenate([np.repeat(k, c) for k, c, d in zip(keys, counts, done) if not d] + [np.zeros(0, np.int64)])
        tokens = np.concatenate([np.frombuffer(t, np.uint64) for t in pdf["tokens"]] + [np.zeros(0, np.uint64)])
        order = np.argsort(tokens)
        tokens, open_keys = tokens[order], open_keys[order]
        same = np.zeros(len(tokens) + 1, bool)
        same[1:-1] = tokens[1:] == tokens[:-1]
        hit = (same[:-1] | same[1:]) & (open_keys != 0)
        found, times = np.unique(open_keys[hit], return_counts=True)
        more = [k for k, d in zip(keys, done) if d]
        support = [c for c, d in zip(counts, done) if d]
        return pd.DataFrame({
            "key": np.concatenate([found, *more]), "support": np.concatenate([times, *support]).astype(np.int64)
        })

    return (
        docs.select("text")
        .mapInArrow(cut, "fragment int, keys binary, counts binary, tokens binary, settled boolean")
        .groupBy("fragment")
        .applyInPandas(count, "key long, support long")
        .groupBy("key")
        .agg(F.sum("support").alias("support"))
    )


def _sets(docs, alive, words):
    """mark, n, copies, tokens array<long> of the classes in alive(mark, rep, n, copies)."""

    def run(batches):
        for batch in sliced(batches):
            ids, marks, rows = batch.column("mark"), [], []
            for i, tokens in token_sets(batch, words):
                if set_hash(tokens) == ids[i].as_py():
                    marks.append((ids[i].as_py(), len(tokens), batch.column("copies")[i].as_py()))
                    rows.append(tokens.view(np.int64))
            sizes = np.cumsum([0, *map(len, rows)])
            flat = pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in marks], pa.binary()), pa.array([m[1] for m in marks], pa.int64()),
                 pa.array([m[2] for m in marks], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)],
                ["mark", "n", "copies", "tokens"],
            )

    here, there = docs.select("doc_id", "text").alias("here"), alive.alias("there")
    rows = here.join(there, F.col("here.doc_id").eqNullSafe(F.col("there.rep"))).select("text", "mark", "copies")
    found = rows.mapInArrow(run, "mark binary, n long, copies long, tokens array<long>")
    return found.dropDuplicates(["mark"])  # one row each, even where a doc_id is repeated


def _prefixes(sets, percent, order_rows):
    """token, mark, n: the n-grams of each set of which a partner must have one; rare ones come first."""
    often = keep(
        sets.select(F.explode("tokens").alias("token")).groupBy("token").count().where(f"count > {LIST}"), "often"
    )
    least = LIST
    while often.where(F.col("count") > least).count() > order_rows:
        least *= 2
    known = often.where(F.col("count") > least).toPandas().sort_values("token")  # at most order_rows
    shared = sets.sparkSession.sparkContext.broadcast((known["token"].to_numpy(), known["count"].to_numpy()))

    def run(batches):
        names, times = shared.value
        for batch in batches:
            marks, n, lists = batch.column("mark"), batch.column("n").to_numpy(), batch.column("tokens")
            out, who, size = [], [], []
            for i in range(batch.num_rows):
                tokens = lists[i].values.to_numpy()
                count = np.zeros(len(tokens), np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, tokens), len(names) - 1)
                    count = np.where(names[at] == tokens, times[at], 0)
                first = tokens[np.lexsort((tokens, count))[: spare(int(n[i]), percent) + 1]]
                out.append(first)
                who.append(np.full(len(first), i))
                size.append(np.full(len(first), n[i]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out)), marks.take(pa.array(np.concatenate(who))), pa.array(np.concatenate(size))],
                    ["token", "mark", "n"],
                )

    return sets.select("mark", "n", "tokens").mapInArrow(run, "token long, mark binary, n long")


def _units(lists):
    """mark, n, unit, block, label: blocks of classes that meet in long lists, and the others one by one."""
    nodes = lists.groupBy("mark").agg(
        F.first("n").alias("n"),
        F.min(F.when(F.col("members") > LIST, F.col("leader"))).alias("hot"),
        F.min("leader").alias("label"),
    )
    band = F.floor(F.log("n") / math.log(1.25)).alias("band")
    hot = nodes.where(F.col("hot").isNotNull()).select("mark", "n", "label", "hot", band)
    parts = hot.groupBy("hot", "band").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("mark"), F.col("parts"))
    blocks = hot.join(parts, ["hot", "band"]).select(
        "mark", "n", F.xxhash64("hot", "band", part).alias("unit"), F.lit(True).alias("block"), "label"
    )
    single = nodes.where(F.col("hot").isNull()).select(
        "mark", "n", F.xxhash64("mark").alias("unit"), F.lit(False).alias("block"), "label"
    )
    return blocks.unionByName(single)


def _pairs(lists, units, percent):
    """u, v (u <= v), block, label: units that share an n-gram of their prefixes and whose sizes allow a link."""
    meet = (
        lists.select("token", "mark")
        .join(units, "mark")
        .groupBy("token", "unit")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.first("block").alias("block"), F.min("label").alias("label"))
    )
    a, b = meet.alias("a"), meet.alias("b")
    fits = (
        (F.col("a.token") == F.col("b.token"))
        & ((F.col("a.unit") < F.col("b.unit")) | ((F.col("a.unit") == F.col("b.unit")) & F.col("a.block")))
        & (F.col("a.high") * 100 >= F.col("b.low") * percent)
        & (F.col("b.high") * 100 >= F.col("a.low") * percent)
    )
    return (
        a.join(b, fits)
        .groupBy(F.col("a.unit").alias("u"), F.col("b.unit").alias("v"))
        .agg(F.first(F.col("a.block") | F.col("b.block")).alias("block"), F.min(F.least("a.label", "b.label")).alias("label"))
    )


def _overlap(left, right, n_left, n_right):
    """Matrix of common n-grams of two lists of sorted arrays."""
    if n_left == n_right == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]], np.int32)
    a, b = np.concatenate(left), np.concatenate(right)
    ia, ib = np.repeat(np.arange(n_left), [len(x) for x in left]), np.repeat(np.arange(n_right), [len(x) for x in right])
    common = np.intersect1d(a, b)
    out = np.zeros((n_left, n_right), np.float32)
    pa_, pb = np.searchsorted(common, a), np.searchsorted(common, b)
    ka, kb = np.isin(a, common), np.isin(b, common)
    pa_, ia, pb, ib = pa_[ka], ia[ka], pb[kb], ib[kb]
    for begin in range(0, len(common), 2048):
        width = min(2048, len(common) - begin)
        ma, mb = np.zeros((n_left, width), np.float32), np.zeros((n_right, width), np.float32)
        sa, sb = (pa_ >= begin) & (pa_ < begin + width), (pb >= begin) & (pb < begin + width)
        ma[ia[sa], pa_[sa] - begin] = 1
        mb[ib[sb], pb[sb] - begin] = 1
        out += ma @ mb.T
    return out.astype(np.int32)


def _verify(pairs, units, sets, percent):
    """a, b, links: links of a spanning forest (b not null), and the number of linked texts of a class (b null)."""
    spark = sets.sparkSession
    sums = pairs.agg(F.count("*"), F.sum(F.col("block").cast("int"))).first()
    groups = max(spark.sparkContext.defaultParallelism, math.ceil(((sums[1] or 0) * BLOCK * BLOCK + sums[0]) / CELLS))
    place = F.when(F.col("block"), F.xxhash64("u", "v")).otherwise(F.xxhash64("label"))
    pairs = pairs.select("u", "v", F.pmod(place, F.lit(groups)).alias("g"))
    needed = pairs.select("g", F.explode(F.array("u", "v")).alias("unit")).distinct()
    def fragment(k):
        return F.filter("tokens", lambda t: F.shiftright(t, 62) == k)

    segments = (
        needed.join(units.select("mark", "unit"), "unit")
        .join(sets, "mark")
        .select("g", "unit", "mark", "n", "copies", F.posexplode(F.array(*map(fragment, range(-2, 2)))).alias("f", "tokens"))
    )
    each = F.explode(F.array(*[F.lit(k) for k in range(FRAGMENTS)]))
    ranges = pairs.select(F.col("g").alias("group"), "u", "v", each.alias("fragment"))

    def ordered(members):
        members = members.sort_values(["unit", "mark"], kind="stable").reset_index(drop=True)
        unit = members["unit"].to_numpy()
        names, starts = np.unique(unit, return_index=True)
        ends = np.append(starts[1:], len(unit))
        return members, {u: (int(s), int(e)) for u, s, e in zip(names.tolist(), starts, ends)}

    def partial(pair, members):
        members, place = ordered(members)
        tokens = [np.asarray(t, np.int64) for t in members["tokens"]]
        pair = pair.sort_values(["u", "v"])
        cells, spans = [], []
        for u, v in zip(pair["u"].tolist(), pair["v"].tolist()):
            (a, b), (c, d) = place[u], place[v]
            cells.append(_overlap(tokens[a:b], tokens[c:d], b - a, d - c).ravel())
            spans += [a, b, c, d]
        first = pair["fragment"].iloc[0] == 0
        return pd.DataFrame({
            "g": [int(pair["group"].iloc[0])], "cells": [np.concatenate(cells).tobytes()],
            "spans": [spans if first else None],
            "marks": [members["mark"].tolist() if first else None],
            "n": [members["n"].tolist() if first else None],
            "copies": [members["copies"].tolist() if first else None],
        })

    def decide(pdf):
        head = pdf[pdf["spans"].notna()].iloc[0]
        total = sum(np.frombuffer(c, np.int32).astype(np.int64) for c in pdf["cells"])
        n, copies, marks = np.asarray(head["n"]), np.asarray(head["copies"]), list(head["marks"])
        links, root, at, edges = np.zeros(len(n), np.int64), list(range(len(n))), 0, []

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for a, b, c, d in np.asarray(head["spans"]).reshape(-1, 4).tolist():
            common = total[at : at + (b - a) * (d - c)].reshape(b - a, d - c)
            at += common.size
            linked = 100 * common >= percent * (n[a:b, None] + n[None, c:d] - common)
            if a == c:
                np.fill_diagonal(linked, False)
            links[a:b] += linked @ copies[c:d]
            if a != c:
                links[c:d] += linked.T @ copies[a:b]
            for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
                x, y = find(a + i), find(c + j)
                if x != y:
                    root[x] = y
                    edges.append((marks[a + i], marks[c + j], 0))
        edges += [(marks[i], None, int(links[i])) for i in np.nonzero(links)[0]]
        return pd.DataFrame(edges, columns=["a", "b", "links"])

    return (
        ranges.groupBy("group", "fragment")
        .cogroup(segments.groupBy("g", "f"))
        .applyInPandas(partial, "g long, cells binary, spans array<int>, marks array<binary>, n array<long>, copies array<long>")
        .groupBy("g")
        .applyInPandas(decide, "a binary, b binary, links long")
    )


def _classified(docs, words=WORDS, percent=PERCENT, order_rows=ORDER_ROWS):
    """doc_id, text_mark, n, best, links of every row; best: the (unnamed, doc_id, text_mark) that comes first in the
    row's component, null for a row without n-grams."""
    bounded_batches(docs.sparkSession)
    members = keep(_members(docs, words), "members")
    classes = members.where("n > 0").groupBy("mark").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_mark")).alias("best"),
        F.first("n").alias("n"), F.first("low").alias("low"),
        F.first("key").alias("key"), F.count("*").alias("copies"),
    )
    total = members.agg(F.sum("low")).first()[0] or 0
    fragments = max(32, math.ceil(total / FRAGMENT_TOKENS))
    support = _support(docs, words, fragments)
    may_lack = F.col("n") - F.ceil(F.col("n") * percent / 100)
    alive = keep(
        classes.join(support, "key", "left")
        .where(F.coalesce("support", F.lit(0)) >= F.col("low") - may_lack)
        .select("mark", "best", F.col("best.doc_id").alias("rep"), "copies"),
        "alive",
    )
    sets = keep(_sets(docs, copied_if_small(alive), words), "sets")
    index = keep(_prefixes(sets, percent, order_rows), "prefixes")
    counts = index.groupBy("token").agg(F.count("*").alias("members"), F.min("mark").alias("leader")).where("members > 1")
    lists = keep(index.join(counts, "token"), "lists")
    units = keep(_units(lists), "units")
    pairs = keep(_pairs(lists, units, percent), "pairs")
    found = keep(_verify(pairs, units, sets, percent), "found")

    stars = components(found.where("b is not null").select("a", "b"))
    roots = stars.select(F.col("a").alias("mark"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("mark"), F.col("b").alias("root")).distinct()
    )
    named = roots.join(alive.select("mark", "best"), "mark")
    least = named.groupBy("root").agg(F.min("best").alias("first"))
    links = found.where("b is null").groupBy(F.col("a").alias("mark")).agg(F.sum("links").alias("links"))
    linked = named.join(least, "root").select("mark", "first").join(links, "mark")
    of_class = classes.select("mark", "best", "copies").join(linked, "mark", "left").select(
        F.col("mark").alias("class"), F.coalesce("first", "best").alias("best"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
    )
    # Rows without a class get keys of their own, so that they do not meet in one task.
    own = F.coalesce("mark", F.col("doc_id").cast("string").cast("binary"), F.lit(b"-"))
    return members.join(of_class, own == F.col("class"), "left").select("doc_id", "text_mark", "n", "best", "links")


def near_copies(docs: DataFrame, words=WORDS, percent=PERCENT, order_rows=ORDER_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of docs(doc_id, text).

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of word n-grams; a text of fewer words
    is one n-gram. component_id is the least doc_id that links lead to, the own included; n_links counts all rows
    linked to a row. Null texts and texts without words have no n-grams, no links and their own component. Repeated
    rows link like any copies. Null ids count as larger than any other.
    """
    return _classified(docs, words, percent, order_rows).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("best.doc_id", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each component; the same columns.

    The row of the least doc_id stays (null ids come last); of rows with that doc_id, one text, and of repeated rows
    the first by their columns. Rows without n-grams stay; of those that share a doc_id, one does.
    """
    found = keep(_classified(docs).select("doc_id", F.col("text_mark").alias("mark"), "best"), "components")
    is_first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("mark") == F.col("best.text_mark"))
    named = found.where("best is not null").select("doc_id", "mark", is_first.alias("first"))
    blank = found.where("best is null and doc_id is not null").select("doc_id", "mark")
    blanks = keep(
        blank.groupBy("doc_id").agg(F.min("mark").alias("least"), F.count("*").alias("rows")).where("rows > 1"), "blanks"
    )
    away = keep(
        named.where("not first").select("doc_id", "mark")
        .unionByName(blank.join(blanks, "doc_id").where("mark <> least").select("doc_id", "mark")).distinct(),
        "copies",
    )
    twice = keep(
        named.where("first").groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark")
        .unionByName(blanks.select("doc_id", F.col("least").alias("mark"))),
        "twice",
    )
    rows = without(docs, away)
    listed = copied_if_small(twice).alias("listed")
    same = F.col("here.doc_id").eqNullSafe(F.col("listed.doc_id")) & (text_mark("here.text") == F.col("listed.mark"))
    again = rows.alias("here").join(listed, same, "left_semi").select(F.struct("*").alias("row"))
    order = Window.partitionBy("row.doc_id", text_mark("row.text")).orderBy(F.to_json("row"))
    one = again.withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*")
    return without(rows, twice).unionByName(one)
