"""Removal of repeated 100-byte strings by a logarithmic family of sampled suffix arrays.

Suffixes are sampled: every 100-byte window has one anchor, the place of its least 32-byte gram by hash. Equal
windows have equal grams at equal offsets, so only suffixes at anchors (one in 35 bytes) are put in order. The
order is that of the grams' 64-bit fingerprints, which is as good as any for finding equal ones. A run is an anchor
with the windows that belong to it.

1. A new batch of documents gets its sorted runs: a row of arrays per fragment of the order and map batch. A run
   carries the fingerprint of all bytes of its windows.
2. Merge-scan: each fragment is merged with that of all existing levels. A run whose bytes occur before goes as a
   whole; of grams that occur with different bytes, one run of each kind is fetched with its bytes.
3. Windows of these runs are compared by 128-bit fingerprints; all but the first (by doc_id and start) are removed.
4. The batch becomes a level; levels of about equal size are merged, so a family of n batches has log n levels.

What repeats inside a map batch is settled there, and very common grams are dealt by their windows, so that no
group grows with the number of copies.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import bounded_batches, keep, text_mark
from chatterscope.llm.hashing import BACK, STEP, TABLE, gathered, mixed, sliced, text_bytes

LENGTH, GRAM = 100, 32
WINDOWS = LENGTH - GRAM + 1
CHUNK = 1 << 18
# The least number of fragments of the order, a power of two, and the bytes of text for which there is one.
FRAGMENTS, FRAGMENT_BYTES = 64, 16 << 20
# Grams with more runs than this are dealt by windows; at most HOT_ROWS of them are sent to the executors.
HOT, HOT_ROWS = 256, 1_000_000
RUNS = 60_000  # fetched runs of one task
LAST = np.iinfo(np.int64).max  # stands for a null doc_id

_up, _down = np.full(CHUNK + LENGTH, STEP), np.full(CHUNK + LENGTH, BACK)
_up[0] = _down[0] = 1
UP, DOWN = np.cumprod(_up, dtype=np.uint64), np.cumprod(_down, dtype=np.uint64)
SECOND = mixed(TABLE + np.uint64(1))

SCANNED = "doc long, mark long, refs binary, spans binary, hot long, times long"
SCANNED_NAMES = [c.split()[0] for c in SCANNED.split(", ")]
SCANNED_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
RUN_SCHEMA = (
    "kind int, fragment int, docs binary, marks binary, counts binary, keys binary, bytes binary, starts binary, windows binary"
)
# Kinds of rows: runs with a gram of their own in a map batch; grams without a run; runs to be fetched.
NAMED, NAMELESS, FETCH = range(3)
BATCH = 4 << 20  # bytes of text that are sorted at once


def _sums(raw, table):
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * UP[: len(raw)], out=total[1:])
    return total


def _hashes(total, at, length):
    return mixed((total[at + length] - total[at]) * DOWN[at])


NO_RUNS = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)


def runs_of(raw, ends):
    """(gram, bytes, start, windows) arrays of some bytes; ends: the end of the text of each place."""
    if len(raw) < LENGTH:
        return NO_RUNS
    total = _sums(raw, TABLE)
    grams = _hashes(total, np.arange(len(raw) - GRAM + 1), GRAM)
    low = np.uint64(20)
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: -(WINDOWS - 64)], least[WINDOWS - 64 :])
    anchor = (least & np.uint64(0xFFFFF)).astype(np.int64)
    at = np.nonzero(ends[: len(anchor)] - np.arange(len(anchor)) >= LENGTH)[0]
    if not len(at):
        return NO_RUNS
    place = anchor[at]
    first = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])]))[0]
    start, count = at[first], np.diff(np.append(first, len(at)))
    whole = _hashes(total, start, count + LENGTH - 1)
    shape = ((place[first] - start) * 256 + count).astype(np.uint64)  # where the anchor lies, and how many windows
    # Least grams are small numbers; mixed once more (one to one), they fill all fragments alike.
    return mixed(grams[place[first]]), mixed(whole + shape), start, count


def all_runs(offsets, data):
    """(row, gram, bytes, start, windows) arrays of all texts, in pieces of at most CHUNK bytes."""
    out, n, i = [], len(offsets) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK - LENGTH, "right")) - 1))
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= CHUNK - LENGTH:
            bounds = np.asarray(offsets[i : j + 1]) - begin
            key, whole, start, count = runs_of(data[begin:end], np.repeat(bounds[1:], np.diff(bounds)))
            row = np.searchsorted(bounds, start, "right") - 1
            out.append((row + i, key, whole, start - bounds[row], count))
        else:
            step = CHUNK - 2 * LENGTH
            for a in range(begin, end, step):
                raw = data[a : min(a + step + LENGTH - 1, end)]
                key, whole, start, count = runs_of(raw, np.full(len(raw), len(raw)))
                out.append((np.full(len(key), i), key, whole, start + (a - begin), count))
        i = j
    if not out:
        return np.zeros(0, np.int64), *NO_RUNS
    return tuple(np.concatenate(x) for x in zip(*out))


def _ids(column):
    return column.cast(pa.int64()).fill_null(int(LAST)).to_numpy(zero_copy_only=False)


def _per_doc(rows):
    """Distinct values of a sorted array and how often each is there."""
    first = np.nonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))[0] if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.diff(np.append(first, len(rows))).astype(np.int32)


def _starts_of(*sorted_arrays):
    """True where a new value (of any of the arrays) begins."""
    new = np.zeros(len(sorted_arrays[0]), bool)
    new[:1] = True
    for x in sorted_arrays:
        new[1:] |= x[1:] != x[:-1]
    return new


def _classes(batch):
    """The runs of a map batch: which have equal bytes before them, and the least of each gram and bytes."""
    ids, marks = _ids(batch.column("doc")), _ids(batch.column("mark"))
    row, key, whole, start, count = all_runs(*text_bytes(batch.column("text")))
    if not len(row):
        return None
    order = np.lexsort((start, marks[row], ids[row], whole, key))
    first = _starts_of(key[order], whole[order])
    least = order[np.nonzero(first)[0]]
    mine = least[np.cumsum(first) - 1]
    later = order[(ids[row[order]] != ids[row[mine]]) | (start[order] != start[mine])]
    new = _starts_of(key[least])
    kinds = np.diff(np.append(np.nonzero(new)[0], len(least)))
    return ids, marks, row, key, whole, start, count, later, least, new, kinds, np.repeat(kinds > 1, kinds)


def _settled(docs):
    """What `_sorted_runs` settles inside its map batches, as rows of SCANNED."""

    def run(batches):
        for batch in gathered(batches, BATCH):
            found = _classes(batch)
            if found is None:
                continue
            ids, marks, row, key, _, start, count, later, least, _, _, several = found
            at = least[several]
            refs = np.zeros(len(at), REF)
            refs["key"], refs["start"], refs["count"] = key[at], start[at], count[at]
            parts = [
                _by_doc(ids[row[at]], marks[row[at]], refs, "refs"),
                _spans(ids[row[later]], marks[row[later]], start[later], start[later] + count[later] + LENGTH - 1),
            ]
            for x in parts:
                if len(x):
                    cells = [x[c].tolist() if c in x else [None] * len(x) for c in SCANNED_NAMES]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, SCANNED_KINDS)], SCANNED_NAMES)

    return docs.mapInArrow(run, SCANNED)


def _sorted_runs(docs, fragments):
    """The runs of a batch of documents(doc, mark, text), see RUN_SCHEMA; the arrays of a row are in document order.

    Inside a map batch, all but the first of runs with equal bytes become spans (`_settled`). A gram that has one kind of bytes
    left gives a named run. One with several gives these as runs to be fetched, and a nameless entry (the
    number of kinds as its start), so that no gram sends more than one entry.
    """

    def cut(batches):
        for batch in gathered(batches, BATCH):
            found = _classes(batch)
            if found is None:
                continue
            ids, marks, row, key, whole, start, count, later, least, new, kinds, several = found
            rows = []
            for kind, at in ((NAMED, least[~several]), (FETCH, least[several]), (NAMELESS, least[new & several])):
                place = (key[at] >> np.uint64(65 - fragments.bit_length())).astype(np.int64)
                cuts = np.searchsorted(place, np.arange(fragments + 1))
                times = kinds[kinds > 1] if kind == NAMELESS else None
                for f in np.unique(place).tolist():
                    mine = at[cuts[f] : cuts[f + 1]]
                    if kind == NAMELESS:
                        head = np.array([-1]), np.array([0]), np.array([len(mine)], np.int32)
                        starts = times[cuts[f] : cuts[f + 1]]
                    else:
                        mine = mine[np.argsort(row[mine], kind="stable")]
                        who, counts = _per_doc(row[mine])
                        head, starts = (ids[who], marks[who], counts), start[mine]
                    rows.append((kind, f, *(x.tobytes() for x in head), key[mine].tobytes(), whole[mine].tobytes(),
                                 starts.astype(np.uint32).tobytes(), count[mine].astype(np.uint8).tobytes()))
            if not rows:
                continue
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=[c.split()[0] for c in RUN_SCHEMA.split(", ")])
                .astype({"kind": "int32", "fragment": "int32"}), preserve_index=False)

    return docs.mapInArrow(cut, RUN_SCHEMA)


REF = np.dtype([("key", "<u8"), ("start", "<u4"), ("count", "u1")])


def _column(pdf, name, kind):
    return np.concatenate([np.frombuffer(x, kind) for x in pdf[name]] + [np.zeros(0, kind)])


def _unpacked(pdf):
    """(doc, mark, bytes, refs) arrays, one entry per run, of packed rows."""
    counts = _column(pdf, "counts", np.int32)
    refs = np.zeros(int(counts.sum()), REF)
    refs["key"], refs["start"] = _column(pdf, "keys", np.uint64), _column(pdf, "starts", np.uint32)
    refs["count"] = _column(pdf, "windows", np.uint8)
    docs, marks = _column(pdf, "docs", np.int64), _column(pdf, "marks", np.int64)
    return np.repeat(docs, counts), np.repeat(marks, counts), _column(pdf, "bytes", np.uint64), refs


def _by_doc(doc, mark, items, name):
    """A row (doc, mark, bytes of the items) for each document."""
    order = np.lexsort((mark, doc))
    doc, mark, items = doc[order], mark[order], items[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])]) if len(doc) else np.zeros(0, bool)
    first = np.nonzero(new)[0]
    ends = np.append(first[1:], len(doc))
    return pd.DataFrame({"doc": doc[first], "mark": mark[first], name: [items[a:b].tobytes() for a, b in zip(first, ends)]})


def _merge_scan(runs, levels):
    """Runs to fetch (refs), spans to remove (spans) of a document, and grams with many entries (hot, times)."""
    rows = runs.where(F.col("kind").isin(NAMED, NAMELESS)).withColumn("old", F.lit(False))
    for level in levels:
        rows = rows.unionByName(level.withColumn("old", F.lit(True)))

    def scan(pdf):
        doc, mark, whole, refs = _unpacked(pdf)
        sizes = [int(np.frombuffer(c, np.int32).sum()) for c in pdf["counts"]]
        old, is_named = (np.repeat(x, sizes) for x in (pdf["old"].to_numpy(), pdf["kind"].to_numpy() != NAMELESS))
        start = refs["start"].astype(np.int64)
        order = np.lexsort((start, mark, doc, whole, refs["key"]))
        key, bytes_, named = refs["key"][order], whole[order], is_named[order]
        new = _starts_of(key)
        group = np.cumsum(new) - 1
        bytes_ = np.where(named, bytes_, 0)
        kind = _starts_of(key, bytes_, named)
        kinds, nameless = np.bincount(group, kind), np.bincount(group, ~named)
        fresh, times = np.bincount(group, ~old[order]), np.bincount(group, np.where(named, kind, start[order]))
        fetch = order[(kind & named & ((kinds > 1) | (nameless > 0))[group] & (fresh > 0)[group])]
        least = order[np.nonzero(kind)[0][np.cumsum(kind) - 1]]
        away = order[named & ((doc[order] != doc[least]) | (start[order] != start[least]))]
        found = _by_doc(doc[fetch], mark[fetch], refs[fetch], "refs").assign(spans=None, hot=None, times=None)
        gone = _spans(doc[away], mark[away], start[away], start[away] + refs["count"][away] + LENGTH - 1)
        many = new & (times > HOT)[group]
        common = pd.DataFrame({"hot": key[many].view(np.int64), "times": times[group][many].astype(np.int64)})
        columns = SCANNED_NAMES
        parts = [x.reindex(columns=columns).astype(object) for x in (found, gone, common) if len(x)]
        return pd.concat(parts) if parts else pd.DataFrame(columns=columns)

    return rows.groupBy("fragment").applyInPandas(scan, SCANNED)


def _windows(raw, sizes, counts):
    """Two fingerprints of each window of byte strings that lie in a row; `counts` windows each."""
    h1, h2, bounds = [], [], np.concatenate([[0], np.cumsum(sizes)])
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + CHUNK, "right")) - 1)
        piece, n = raw[bounds[i] : bounds[j]], counts[i:j]
        shift = np.repeat(bounds[i:j] - bounds[i] - (np.cumsum(n) - n), n)
        at = np.arange(len(shift)) + shift
        h1.append(_hashes(_sums(piece, TABLE), at, LENGTH))
        h2.append(_hashes(_sums(piece, SECOND), at, LENGTH))
        i = j
    empty = [np.zeros(0, np.uint64)]
    return np.concatenate(h1 + empty), np.concatenate(h2 + empty)


def _places(starts, counts):
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(len(shift)) + shift


def _later(h1, h2, doc, mark, place):
    """Which windows have an equal one before them; and the least of each class."""
    order = np.lexsort((place, doc, h2, h1))
    a, b, d, p = h1[order], h2[order], doc[order], place[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    first = np.nonzero(new)[0][np.cumsum(new) - 1] if len(a) else np.zeros(0, np.int64)
    later = (d > d[first]) | (p > p[first])
    return order[later], order[new]


def _spans(doc, mark, start, end):
    """A row (doc, mark, int64 pairs) of the united spans of each document."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order], end[order]
    if not len(doc):
        return pd.DataFrame({"doc": doc, "mark": mark, "spans": []})
    apart = np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])
    group = np.cumsum(apart) - 1
    far = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    new = apart.copy()
    new[1:] |= start[1:] > far[:-1]
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(doc)) - 1
    return _by_doc(doc[first], mark[first], np.stack([start[first], far[last]], axis=1), "spans")


CONTEXTS = "fragment int, kind int, docs binary, marks binary, starts binary, counts binary, data binary"


def _fetched(docs, flags, hot, parts):
    """Bytes of the flagged runs, dealt by gram; windows of hot grams, dealt by fingerprint; spans settled here."""

    def run(batches):
        known = hot.value
        for batch in gathered(batches, BATCH):
            ids, marks = _ids(batch.column("doc")), _ids(batch.column("mark"))
            offsets, data = text_bytes(batch.column("text"))
            lists = batch.column("refs")
            sizes = [sum(len(x) for x in lists[i].as_py()) // REF.itemsize for i in range(batch.num_rows)]
            refs = np.frombuffer(b"".join(x for i in range(batch.num_rows) for x in lists[i].as_py()), REF)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((refs["start"], marks[row], ids[row]))  # the first of equal ones comes first
            row, refs = row[order], refs[order]
            begin = np.asarray(offsets)[row] + refs["start"]
            length = refs["count"].astype(np.int64) + LENGTH - 1
            text, seen, keep_at, away = memoryview(data), {}, [], []
            for i, (a, n) in enumerate(zip(begin.tolist(), length.tolist())):
                if seen.setdefault(bytes(text[a : a + n]), i) == i:
                    keep_at.append(i)
                elif (ids[row[i]], refs["start"][i]) != (ids[row[seen[bytes(text[a : a + n])]]], refs["start"][seen[bytes(text[a : a + n])]]):
                    away.append(i)
            keep_at, away = np.array(keep_at, np.int64), np.array(away, np.int64)
            start = refs["start"].astype(np.int64)
            done = [(ids[row[away]], marks[row[away]], start[away], start[away] + length[away])]
            at = np.minimum(np.searchsorted(known, refs["key"][keep_at]), max(0, len(known) - 1))
            is_hot = known[at] == refs["key"][keep_at] if len(known) else np.zeros(len(keep_at), bool)
            rows = []
            cold = keep_at[~is_hot]
            place = (mixed(refs["key"][cold]) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(place, kind="stable")
            cold, place = cold[by], place[by]
            names, first = np.unique(place, return_index=True)
            for f, a, b in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(place)]):
                mine = cold[a:b]
                raw = b"".join(bytes(text[x : x + n]) for x, n in zip(begin[mine].tolist(), length[mine].tolist()))
                rows.append((f, 0, ids[row[mine]].tobytes(), marks[row[mine]].tobytes(), start[mine].tobytes(),
                             refs["count"][mine].tobytes(), raw))
            common = keep_at[is_hot]
            if len(common):
                raw = np.frombuffer(b"".join(bytes(text[x : x + n]) for x, n in zip(begin[common].tolist(), length[common].tolist())), np.uint8)
                counts = refs["count"][common].astype(np.int64)
                h1, h2 = _windows(raw, length[common], counts)
                who, p = np.repeat(row[common], counts), _places(start[common], counts)
                later, least = _later(h1, h2, ids[who], marks[who], p)
                done.append((ids[who[later]], marks[who[later]], p[later], p[later] + LENGTH))
                place = (h1[least] % np.uint64(parts)).astype(np.int64)
                by = np.argsort(place, kind="stable")
                least, place = least[by], place[by]
                names, first = np.unique(place, return_index=True)
                for f, a, b in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(place)]):
                    mine = least[a:b]
                    rows.append((f, 1, ids[who[mine]].tobytes(), marks[who[mine]].tobytes(), p[mine].tobytes(), b"",
                                 h1[mine].tobytes() + h2[mine].tobytes()))
            spans = _spans(*(np.concatenate(x) for x in zip(*done)))
            if len(spans):
                counts = np.array([len(s) // 16 for s in spans["spans"]], np.int64)
                rows.append((int(abs(int(ids[0])) % parts), 2, spans["doc"].to_numpy(np.int64).tobytes(), spans["mark"].to_numpy(np.int64).tobytes(),
                             b"", counts.tobytes(), b"".join(spans["spans"])))
            if rows:
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(rows, columns=[c.split()[0] for c in CONTEXTS.split(", ")]).astype({"fragment": "int32", "kind": "int32"}),
                    preserve_index=False)

    here, there = docs.alias("here"), flags.alias("there")
    same = (F.col("here.doc") == F.col("there.doc")) & (F.col("here.mark") == F.col("there.mark"))
    rows = here.join(there, same).select("here.doc", "here.mark", "here.text", "there.refs")
    return rows.mapInArrow(run, CONTEXTS)


def _compared(contexts):
    """doc, mark, spans (int64 pairs) to be removed."""

    def run(pdf):
        h1, h2, doc, mark, place, found = [], [], [], [], [], []
        for r in pdf.itertuples():
            ids, marks = np.frombuffer(r.docs, np.int64), np.frombuffer(r.marks, np.int64)
            if r.kind == 2:
                counts = np.frombuffer(r.counts, np.int64)
                pairs = np.frombuffer(r.data, np.int64).reshape(-1, 2)
                found.append((np.repeat(ids, counts), np.repeat(marks, counts), pairs[:, 0], pairs[:, 1]))
                continue
            starts = np.frombuffer(r.starts, np.int64)
            if r.kind == 1:
                pair = np.frombuffer(r.data, np.uint64).reshape(2, -1)
                a, b, counts = pair[0], pair[1], np.ones(len(ids), np.int64)
            else:
                counts = np.frombuffer(r.counts, np.uint8).astype(np.int64)
                a, b = _windows(np.frombuffer(r.data, np.uint8), counts + LENGTH - 1, counts)
            h1.append(a)
            h2.append(b)
            doc.append(np.repeat(ids, counts))
            mark.append(np.repeat(marks, counts))
            place.append(_places(starts, counts))
        if h1:
            h1, h2, doc, mark, place = (np.concatenate(x) for x in (h1, h2, doc, mark, place))
            later, _ = _later(h1, h2, doc, mark, place)
            found.append((doc[later], mark[later], place[later], place[later] + LENGTH))
        return _spans(*(np.concatenate(x) for x in zip(*found)))

    return contexts.groupBy("fragment").applyInPandas(run, "doc long, mark long, spans binary")


def _cut(docs, spans, columns):
    """columns of docs with the removed spans, in bytes of the text."""

    def run(batches):
        for batch in sliced(batches):
            offsets, data = text_bytes(batch.column("text"))
            lists, out = batch.column("spans"), []
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                mine = lists[i].as_py() or []
                pairs = sorted(map(tuple, np.frombuffer(b"".join(mine), np.int64).reshape(-1, 2).tolist()))
                united = []
                for a, b in pairs:
                    if united and a <= united[-1][1]:
                        united[-1][1] = max(b, united[-1][1])
                    else:
                        united.append([a, b])
                at, kept = 0, []
                for a, b in united:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join(kept) + raw[at:]
                out.append((len(raw), len(raw) - len(rest), len(united), hashlib.sha256(rest).hexdigest(),
                            np.array(united, np.int64).tobytes()))
            kept = [batch.column(k) for k in range(len(columns))]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                [*columns, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    here, there = docs.alias("here"), spans.alias("there")
    same = (F.col("here.doc") == F.col("there.doc")) & (F.col("here.mark") == F.col("there.mark"))
    rows = here.join(there, same, "left").select(*[F.col(f"here.{c}") for c in columns], "here.text", "there.spans")
    schema = docs.select(*columns).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("removed", "binary")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


class SuffixFamily:
    """Levels of sorted runs with their documents. Batches come in the order of doc_id: a later one holds larger ids.

    `fragments`, a power of two, cuts the order of the whole family; `fragments_for` gives it from the bytes of all texts
    that are expected, so that a fragment fits a task.
    """

    def __init__(self, fragments=FRAGMENTS):
        self.fragments = fragments
        self.levels = []  # (batches it holds, documents, runs)

    @staticmethod
    def fragments_for(n_bytes):
        return max(FRAGMENTS, 1 << (n_bytes // FRAGMENT_BYTES).bit_length())

    def add(self, docs: DataFrame, store=True) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (spans as int64 pairs) for each row of docs.

        A byte goes if a 100-byte string over it starts earlier, in a smaller doc_id or earlier in the same one, here
        or in any batch before. Texts of fewer bytes lose nothing; null texts are empty. Rows that agree in doc_id and
        text are one document; null ids count as the largest. With `store`, the batch becomes a level.
        """
        spark = docs.sparkSession
        bounded_batches(spark)
        docs = docs.select(
            "doc_id", F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), text_mark().alias("mark"), "text"
        )
        runs = _sorted_runs(docs.select("doc", "mark", "text"), self.fragments)
        runs = keep(runs, "runs") if store else runs  # read twice: it is cheaper to work out than to hold on disk
        levels = [level for _, _, level in self.levels]
        settled = _settled(docs.select("doc", "mark", "text"))
        scanned = keep(_merge_scan(runs, levels).unionByName(settled), "scanned")
        least = HOT
        while scanned.where(F.col("times") > least).count() > HOT_ROWS:
            least *= 2
        hot = scanned.where(F.col("times") > least).select("hot").toPandas()["hot"]  # at most HOT_ROWS
        shared = spark.sparkContext.broadcast(np.sort(hot.to_numpy(np.int64).view(np.uint64)))
        named = scanned.where("refs is not null")
        total = (named.agg(F.sum(F.length("refs"))).first()[0] or 0) // REF.itemsize
        flags = named.groupBy("doc", "mark").agg(F.collect_list("refs").alias("refs"))
        texts = docs.select("doc", "mark", "text")
        for _, before, _ in self.levels:
            texts = texts.unionByName(before)
        parts = max(FRAGMENTS, total // RUNS)
        spans = _compared(_fetched(texts, flags, shared, parts))
        spans = spans.unionByName(scanned.where("spans is not null").select("doc", "mark", "spans"))
        spans = spans.groupBy("doc", "mark").agg(F.collect_list("spans").alias("spans"))
        if store:
            self._store(docs.select("doc", "mark", "text"), runs)
        return _cut(docs, spans, ["doc_id"])

    def _store(self, docs, runs):
        self.levels.append((1, docs, runs.where(F.col("kind").isin(NAMED, FETCH))))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, docs, runs), (_, before, old) = self.levels.pop(), self.levels.pop()
            merged = keep(old.unionByName(runs).repartition("fragment").sortWithinPartitions("fragment"), "level")
            self.levels.append((2 * n, before.unionByName(docs), merged))


def dedup(docs: DataFrame) -> DataFrame:
    """The result of one batch of all documents; see SuffixFamily.add."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return SuffixFamily(SuffixFamily.fragments_for(n_bytes)).add(docs, store=False)
