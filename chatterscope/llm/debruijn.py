"""Removal of passages that occur more than once, over a compacted de Bruijn graph of words.

Edges are the runs of `LENGTH` words (k-mers) of the texts; only those that occur at least twice count.

1. Edges next to each other that share their least gram of GRAM words travel as one run, keyed by that gram, so that equal
   edges meet in one bucket. Runs of equal content are a partial path already; of grams with runs of different content, the
   runs are noted, to be compared edge by edge.
2. Repeated partial paths that follow each other are steps of the graph. Where all occurrences of the first go on to the
   second, and all of the second come from the first, there is no branch: joins on the steps compact such paths.
3. Source coordinates are verified: the texts are read again at the compacted paths' places, and each path, and each edge of the
   noted runs, gets two further 64-bit hashes. Places whose pair of hashes occurs twice are removed.

Documents are named by doc_id and a hash of the text. What repeats inside a map batch is settled there, and a batch sends one entry
for a gram, so no bucket grows with the number of copies.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import bounded_batches, copied_if_small, keep, text_mark
from chatterscope.llm.hashing import CHUNK, DOWN, TABLE, UP, byte_mask, gathered, mixed, sliced, text_bytes, word_hashes

LENGTH, GRAM = 35, 8
SEPARATORS = byte_mask((0x20, 0x20), (0x09, 0x0D))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SECOND = mixed(TABLE + np.uint64(7))
# Bytes of text that a task cuts at once; the least number of buckets, bytes of text and number of items for which there is one.
BATCH, BUCKETS, BUCKET_BYTES, BUCKET_ITEMS = 4 << 20, 64, 16 << 20, 400_000
LAST = np.iinfo(np.int64).max  # stands for a null doc_id

# Kinds of packed entries: a run; a gram with several runs in its batch; runs that are settled as steps; runs to be noted.
RUN, SEVERAL, STEP, NOTED = range(4)
ENTRIES = "kind int, bucket int, docs binary, marks binary, keys binary, wholes binary, starts binary, counts binary"
FOUND = "kind int, doc long, mark long, start int, n int, whole long"
ITEMS = "bucket int, docs binary, marks binary, first binary, second binary, starts binary, sizes binary"
SPANS = "doc long, mark long, spans binary"


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


KIND_OF = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(schema, columns):
    kinds = [KIND_OF[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _names(schema))


def _sums(words):
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * UP[: len(words)], out=total[1:])
    return total


def _hashes(total, at, length):
    return mixed((total[at + length] - total[at]) * DOWN[at])


def _least(grams, width):
    """The place of the least gram of each `width` that follow each other, the first of equal ones."""
    low = np.uint64(20)
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    covered = 1
    while 2 * covered <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[: covered - width], least[width - covered :])
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64)


def runs_of(words, bounds, length=LENGTH):
    """(key, whole, start, count) of the runs of edges in the words of texts that end at bounds[1:]; at most CHUNK words."""
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(words) < length:
        return nothing
    gram = min(GRAM, length)
    total = _sums(words)
    grams = _hashes(total, np.arange(len(words) - gram + 1), gram)
    anchor = _least(grams, length - gram + 1)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.nonzero(ends[: len(anchor)] - np.arange(len(anchor)) >= length)[0]
    if not len(at):
        return nothing
    place = anchor[at]
    first = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])]))[0]
    start, count = at[first], np.diff(np.append(first, len(at)))
    shape = ((place[first] - start) * 256 + count).astype(np.uint64)
    # Least grams are small numbers; mixed once more, they fill all buckets alike.
    return mixed(grams[place[first]]), mixed(_hashes(total, start, count + length - 1) + shape), start, count


def _words_of(offsets, data, table):
    """Lists of texts' words, (first text, words, bounds), of at most CHUNK words; a longer text comes alone, in one piece."""
    held, at, n = [], 0, 0
    for i, words in word_hashes(offsets, data, SEPARATORS, table):
        if held and n + len(words) > CHUNK:
            yield at, np.concatenate(held), np.cumsum([0, *map(len, held)])
            held, n = [], 0
        if not held:
            at = i
        held.append(words)
        n += len(words)
    if held:
        yield at, np.concatenate(held), np.cumsum([0, *map(len, held)])


def all_runs(offsets, data, length=LENGTH):
    """(row, key, whole, start, count) of all texts; starts count words of a text."""
    out = []
    for at, words, bounds in _words_of(offsets, data, TABLE):
        if len(words) <= CHUNK:
            key, whole, start, count = runs_of(words, bounds, length)
            row = np.searchsorted(bounds, start, "right") - 1
            out.append((row + at, key, whole, start - bounds[row], count))
        else:
            step = CHUNK - length
            for a in range(0, len(words), step):
                piece = words[a : a + step + length - 1]
                key, whole, start, count = runs_of(piece, np.array([0, len(piece)]), length)
                out.append((np.full(len(key), at), key, whole, start + a, count))
    if not out:
        return tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _new(*sorted_arrays):
    """True where a new value of any of the arrays begins."""
    new = np.zeros(len(sorted_arrays[0]), bool)
    new[:1] = True
    for x in sorted_arrays:
        new[1:] |= x[1:] != x[:-1]
    return new


def _ids(column):
    return column.cast(pa.int64()).fill_null(int(LAST)).to_numpy(zero_copy_only=False)


def _dealt(bucket):
    """(bucket, places) of what goes to each bucket."""
    by = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[by], return_index=True)
    return zip(names.tolist(), np.split(by, first[1:]))


def _entries(docs, buckets, length):
    """ENTRIES of documents(doc, mark, text)."""

    def run(batches):
        for batch in gathered(batches, BATCH):
            ids, marks = _ids(batch.column("doc")), _ids(batch.column("mark"))
            row, key, whole, start, count = all_runs(*text_bytes(batch.column("text")), length)
            if not len(row):
                continue
            order = np.lexsort((whole, key))
            first = _new(key[order], whole[order])
            of = np.cumsum(first) - 1
            times = np.bincount(of)
            settled = order[times[of] > 1]  # runs with equal ones in this batch
            least, by_key = order[first], _new(key[order[first]])
            kinds = np.bincount(np.cumsum(by_key) - 1)
            several = np.repeat(kinds > 1, kinds)
            rows = []
            parts = (RUN, least[~several], (times > 1)[~several]), (SEVERAL, least[several & by_key], None), (STEP, settled, None), (NOTED, least[several], None)
            for kind, at, is_settled in parts:
                # The high bit of a run's count tells that its batch has settled it as a step.
                counts = count[at] if is_settled is None else count[at] + 128 * is_settled
                for b, mine in _dealt((key[at] % np.uint64(buckets)).astype(np.int64)):
                    x = at[mine]
                    named = kind != SEVERAL
                    rows.append((kind, b, ids[row[x]].tobytes() if named else b"", marks[row[x]].tobytes() if named else b"",
                                 key[x].tobytes() if kind < STEP else b"", whole[x].tobytes() if named else b"",
                                 start[x].astype(np.int32).tobytes() if named else b"", counts[mine].astype(np.uint8).tobytes() if named else b""))
            yield _batch(ENTRIES, zip(*rows))

    return docs.mapInArrow(run, ENTRIES)


def _column(pdf, name, kind):
    return np.concatenate([np.frombuffer(x, kind) for x in pdf[name]] + [np.zeros(0, kind)])


def _met(entries):
    """FOUND rows of kind STEP (occurrences of repeated runs) and NOTED (a run of each content of a gram with several)."""

    def meet(_, table):
        pdf = table.to_pandas()
        out = []
        for kind in (STEP, NOTED):
            part = pdf[pdf["kind"] == kind]
            out.append((kind, *(_column(part, c, k) for c, k in RUN_COLUMNS)))
        runs = pdf[pdf["kind"] == RUN]
        doc, mark, whole, start, count = (_column(runs, c, k) for c, k in RUN_COLUMNS)
        key = np.concatenate([_column(runs, "keys", np.uint64), _column(pdf[pdf["kind"] == SEVERAL], "keys", np.uint64)])
        if len(key):
            named = np.arange(len(key)) < len(doc)
            content = np.concatenate([whole, np.zeros(len(key) - len(doc), np.uint64)])
            order = np.lexsort((~named, content, key))
            new_key, new = _new(key[order]), _new(key[order], content[order], named[order])
            group, of = np.cumsum(new_key) - 1, np.cumsum(new) - 1
            kinds, several = np.bincount(group, new), np.bincount(group, ~named[order])
            noted = order[new & named[order] & ((kinds > 1) | (several > 0))[group]]
            settled = np.concatenate([count >= 128, np.zeros(len(key) - len(doc), bool)])
            times = np.bincount(of, 1 + settled[order])
            step = order[named[order] & (times > 1)[of] & ~settled[order]]
            for kind, x in ((STEP, step), (NOTED, noted)):
                out.append((kind, doc[x], mark[x], whole[x], start[x], count[x]))
        columns = [np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in out])]
        columns += [np.concatenate([x[k] for x in out]) for k in range(1, 6)]
        kind, doc, mark, whole, start, count = columns
        n = (count & 127).astype(np.int32)
        return pa.Table.from_batches([_batch(FOUND, (kind, doc, mark, start, n, whole.view(np.int64)))])

    return entries.groupBy("bucket").applyInArrow(meet, FOUND)


RUN_COLUMNS = (("docs", np.int64), ("marks", np.int64), ("wholes", np.uint64), ("starts", np.int32), ("counts", np.uint8))


def _steps(found):
    """doc, mark, start, n, whole, before, after: the repeated runs, each with the content of the runs next to it."""
    runs = found.where(F.col("kind") == STEP).groupBy("doc", "mark").agg(
        F.array_sort(F.collect_set(F.struct("start", "n", "whole"))).alias("runs")
    )

    def near(i):
        mine, left, right = F.get("runs", i), F.get("runs", i - 1), F.get("runs", i + 1)
        return F.struct(
            mine.start.alias("start"), mine.n.alias("n"), mine.whole.alias("whole"),
            F.when(left.start + left.n == mine.start, left.whole).alias("before"),
            F.when(mine.start + mine.n == right.start, right.whole).alias("after"),
        )

    return runs.select("doc", "mark", F.explode(F.transform("runs", lambda _, i: near(i))).alias("s")).select("doc", "mark", "s.*")


def chains(steps: DataFrame) -> DataFrame:
    """a, b: partial paths without a branch in between; all occurrences of a go on to b, and all of b come from a.

    steps has whole, before, after. Where a text ends, or goes on with words that occur once, is a branch, too.
    """
    def sides(c):
        return [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}")]

    def single(c):
        return (F.col(f"n_{c}") == F.col("n")) & (F.col(f"least_{c}") == F.col(f"most_{c}"))

    nodes = steps.groupBy("whole").agg(F.count("*").alias("n"), *sides("before"), *sides("after"))
    ahead = nodes.where(single("after")).select(F.col("whole").alias("a"), F.col("least_after").alias("b"))
    back = nodes.where(single("before")).select(F.col("least_before").alias("a"), F.col("whole").alias("b"))
    return ahead.join(back, ["a", "b"])


def _places(found, steps):
    """doc, mark, places: what is to be verified in a document. glued: the path goes on from the place before."""
    # As a table of its own, links (16 bytes a row) are copied while they are few, or else join as a plain shuffle whose hot keys
    # adaptive execution can split: one passage may be on a large part of all steps.
    links = copied_if_small(keep(chains(steps), "links")).alias("c")
    on = (F.col("s.before") == F.col("c.a")) & (F.col("s.whole") == F.col("c.b"))

    def place(glued):
        return F.struct(F.lit(STEP).alias("kind"), "s.start", "s.n", glued.alias("glued")).alias("place")

    # Most paths begin where no repeated run lies before; they need no partner, and their missing key would be a hot one.
    starts = steps.alias("s").where("before IS NULL").select("s.doc", "s.mark", place(F.lit(False)))
    goes_on = steps.alias("s").where("before IS NOT NULL").join(links, on, "left")
    paths = starts.unionByName(goes_on.select("s.doc", "s.mark", place(F.col("c.a").isNotNull())))
    noted = found.where(F.col("kind") == NOTED).select(
        "doc", "mark", F.struct(F.col("kind"), "start", "n", F.lit(False).alias("glued")).alias("place")
    )
    return paths.unionByName(noted).groupBy("doc", "mark").agg(F.array_sort(F.collect_set("place")).alias("places"))


def _spots(places, length):
    """(starts, sizes in words) of the compacted paths and of the single edges at some places of a text."""
    kind, start, n = (np.array([p[c] for p in places], np.int64) for c in ("kind", "start", "n"))
    glued = np.array([p["glued"] for p in places], bool)
    step = kind == STEP
    heads = np.nonzero(step & ~glued)[0]
    tails = np.append(heads[1:], np.count_nonzero(step)) - 1
    sizes = start[tails] + n[tails] + length - 1 - start[heads] if len(heads) else np.zeros(0, np.int64)
    edges, counts = start[~step], n[~step]
    shift = np.repeat(edges - (np.cumsum(counts) - counts), counts)
    single = np.arange(len(shift)) + shift
    return np.concatenate([start[heads], single]), np.concatenate([sizes, np.full(len(single), length)])


def _sizes_hashed(words, start, size):
    """Hashes of runs of words, which depend on the words alone; memory stays bounded for long texts and runs."""
    out, half = np.zeros(len(start), np.uint64), CHUNK // 2
    for a in range(0, len(words), half):
        mine = np.nonzero((start >= a) & (start < a + half) & (size <= half))[0]
        if len(mine):
            out[mine] = _hashes(_sums(words[a : a + CHUNK]), start[mine] - a, size[mine])
    for i in np.nonzero(size > half)[0].tolist():
        h = np.zeros(1, np.uint64)
        for b in range(int(start[i]), int(start[i] + size[i]), half):
            h = mixed(h + _sums(words[b : min(b + half, int(start[i] + size[i]))])[-1:])
        out[i] = h[0]
    return mixed(out + size.astype(np.uint64))


def _items(docs, places, buckets, length):
    """ITEMS of the texts at the places; those with an equal one in their batch are settled (an item with a size below 0)."""

    def run(batches):
        for batch in gathered(batches, BATCH):
            ids, marks = _ids(batch.column("doc")), _ids(batch.column("mark"))
            offsets, data = text_bytes(batch.column("text"))
            lists = batch.column("places").to_pylist()
            hashed = zip(word_hashes(offsets, data, SEPARATORS, TABLE), word_hashes(offsets, data, SEPARATORS, SECOND))
            parts = []
            for (i, one), (_, two) in hashed:
                start, size = _spots(lists[i], length)
                parts.append((np.full(len(start), i), start, size, _sizes_hashed(one, start, size), _sizes_hashed(two, start, size)))
            if not parts:
                continue
            row, start, size, one, two = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, row, two, one))
            first = _new(one[order], two[order])
            of = np.cumsum(first) - 1
            settled = np.zeros(len(row), bool)
            settled[order] = (np.bincount(of) > 1)[of] if len(of) else False
            # All places of settled items go on, but without hashes; only the first stands for them with its hashes.
            one_of_each = order[first]
            rows = []
            for at, with_hashes in ((one_of_each, True), (np.setdiff1d(np.nonzero(settled)[0], one_of_each), False)):
                for b, mine in _dealt((one[at] % np.uint64(buckets)).astype(np.int64) if with_hashes else ids[row[at]] % buckets):
                    x = at[mine]
                    rows.append((b, ids[row[x]].tobytes(), marks[row[x]].tobytes(), one[x].tobytes() if with_hashes else b"",
                                 two[x].tobytes() if with_hashes else b"", start[x].astype(np.int32).tobytes(),
                                 np.where(settled[x], -size[x], size[x]).astype(np.int32).tobytes()))
            if rows:
                yield _batch(ITEMS, zip(*rows))

    here, there = docs.alias("here"), places.alias("there")
    joined = here.join(there, _same_document()).select("here.doc", "here.mark", "here.text", "there.places")
    return joined.mapInArrow(run, ITEMS)


def _same_document():
    return (F.col("here.doc") == F.col("there.doc")) & (F.col("here.mark") == F.col("there.mark"))


def united(doc, mark, start, end):
    """Columns of SPANS: the united spans of each document, as pairs of 32-bit integers."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(doc):
        return [], [], []
    apart = _new(doc, mark)
    group = np.cumsum(apart) - 1
    far = np.maximum.accumulate(end + (group << 40)) - (group << 40)
    new = apart.copy()
    new[1:] |= start[1:] > far[:-1]
    first = np.nonzero(new)[0]
    pairs = np.stack([start[first], far[np.append(first[1:], len(doc)) - 1]], axis=1).astype(np.int32)
    heads = np.nonzero(apart[first])[0]
    return doc[first][heads], mark[first][heads], [x.tobytes() for x in np.split(pairs, heads[1:])]


def _verified(items):
    """SPANS of the places whose words occur at another place, too."""

    def compare(_, table):
        pdf = table.to_pandas()
        hashed = pdf["first"].map(len) > 0
        part = pdf[hashed]
        one, two = _column(part, "first", np.uint64), _column(part, "second", np.uint64)
        doc, mark, start, size = (_column(part, c, k) for c, k in (("docs", np.int64), ("marks", np.int64), ("starts", np.int32), ("sizes", np.int32)))
        order = np.lexsort((two, one))
        of = np.cumsum(_new(one[order], two[order])) - 1
        again = order[(np.bincount(of, 1 + (size[order] < 0)) > 1)[of]] if len(of) else order
        rest = pdf[~hashed]
        more = [_column(rest, c, k) for c, k in (("docs", np.int64), ("marks", np.int64), ("starts", np.int32), ("sizes", np.int32))]
        doc, mark, start, size = (np.concatenate([a[again], b]) for a, b in zip((doc, mark, start, size), more))
        return pa.Table.from_batches([_batch(SPANS, united(doc, mark, start, start.astype(np.int64) + np.abs(size)))])

    return items.groupBy("bucket").applyInArrow(compare, SPANS)


CUT = "n_words long, n_removed long, n_spans long, kept string, spans array<struct<start:int,end:int>>"


def _cut(docs, spans):
    """doc_id and CUT of each document."""
    pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in sliced(batches):
            out = []
            for text, lists in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = WORD.findall((text or "").encode())
                found = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 2) for x in lists or []] + [np.zeros((0, 2), np.int32)])
                zero = np.zeros(len(found), np.int64)
                merged = united(zero, zero, found[:, 0], found[:, 1])[2]
                merged = np.frombuffer(merged[0], np.int32).reshape(-1, 2).tolist() if merged else []
                kept, at = [], 0
                for a, b in merged:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((len(words), len(words) - len(kept), len(merged), b" ".join(kept).decode(), [{"start": a, "end": b} for a, b in merged]))
            columns = list(zip(*out)) or [()] * 5
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string(), pairs
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "n_removed", "n_spans", "kept", "spans"])

    here, there = docs.alias("here"), spans.alias("there")
    joined = here.join(there, _same_document(), "left").select("here.doc_id", "here.text", "there.spans")
    return joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {CUT}")


def substring_dedup(docs: DataFrame, length=LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept, spans of each row of docs.

    Words are what is between spaces, tabs and line breaks. A word goes if any `length` consecutive words over it also start
    anywhere else, in this row or another; all occurrences go, the first included. kept: the words that stay, joined by spaces;
    spans: the runs of removed words. Texts with fewer words lose nothing; a null text has no words. Equal rows are
    copies of each other. doc_id may be null or repeat. An empty table gives no rows. Words are compared by hashes,
    by 64 bits to find candidates and by two others at each place that is removed.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc"), text_mark().alias("mark"), "text")
    texts = docs.select("doc", "mark", "text")
    found = keep(_met(_entries(texts, max(BUCKETS, n_bytes // BUCKET_BYTES), length)), "runs")
    steps = keep(_steps(found), "steps")
    places = _places(found, steps)
    total = found.where(F.col("kind") == NOTED).agg(F.sum("n")).first()[0] or 0
    items = _items(texts, places, max(BUCKETS, total // BUCKET_ITEMS), length)
    spans = keep(_verified(items), "spans").groupBy("doc", "mark").agg(F.collect_list("spans").alias("spans"))
    return _cut(docs, spans)
