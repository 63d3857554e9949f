"""Hard negatives of anchor vectors, with exact integer scores by the method of the Four Russians.

1. Components become integers. Blocks of anchors, bounded in bytes, are sent to the tasks one after the other; each task
   reads its share of the vectors, so no vector is shuffled and a frequent label is no hot spot.
2. A task makes a table for each group of eight dimensions: the sum of an anchor's components over each of the 256 subsets.
   The vectors' integers are cut into bit planes, and a plane's bits of eight dimensions packed into a byte, which is an
   index into the table. Doubling and adding the looked-up sums from the highest plane down gives the full inner products.
   The sums of a plane are added up in 16 bits where the anchors' components allow it.
3. Pass one keeps each anchor's best rows of its own label: best of a task, then best of all. With the scores of these
   positives known, pass two keeps the best rows of other labels inside each positive's band of scores. Anchors and the rows
   of a batch are sorted by label, so that a pass scores few rows of labels that it does not ask for.

What is held for a block does not grow with the vectors: a task sends at most `positives` rows for an anchor, then at most
`negatives` rows for an anchor and positive.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chatterscope.llm.common import keep, scratch_path

SCALE = 256
GROUP = 8  # dimensions of a table
# Bytes of the components of the anchors that are sent to the executors at once, and anchors that share tables in a task.
BLOCK_BYTES = 8 << 20
TABLE_ANCHORS = 256
TABLE_BYTES = 32 << 20  # of the tables that a task keeps from one batch to the next
# Vectors that are scored at once; the first few are less, so that the bounds of the best ones are soon near.
STEPS = (32, 128, 256)
# Pairs that a task may score before the vectors are dealt out anew, if the others have much less to do.
TASK_PAIRS = 100_000_000
NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id, and sorts last

FOUND = "anchor long, positive int, found_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding (doubles) of the rows with a label, a vector and only finite components."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), vector.alias("embedding"))
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)


def integers(lists, dimensions=None):
    """floor(256 * x) of an Arrow column of lists, as a matrix; missing components of shorter vectors count as 0.

    64-bit where all integers fit, else Python's own integers.
    """
    offsets = np.asarray(lists.offsets, np.int64)
    sizes = np.diff(offsets)
    flat = np.floor(SCALE * np.asarray(lists.values, np.float64)[offsets[0] : offsets[-1]])
    fits = not len(flat) or np.abs(flat).max() < 2.0**31
    values = flat.astype(np.int64) if fits else np.array([int(x) for x in flat], object)
    width = -(-max(int(sizes.max(initial=0)), dimensions or 0) // GROUP) * GROUP
    out = np.zeros((len(sizes), width), values.dtype)
    if len(sizes) and (sizes == sizes[0]).all():
        out[:, : sizes[0]] = values.reshape(len(sizes), -1)
        return out
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (offsets[:-1] - offsets[0])[row]] = values
    return out


def subset_tables(anchors):
    """For each group of dimensions a table (256, anchors): the sums of the components whose bits are set."""
    tables = []
    for g in range(0, anchors.shape[1], GROUP):
        table = np.zeros((1 << GROUP, len(anchors)), anchors.dtype)
        for k in range(GROUP):
            np.add(table[: 1 << k], anchors[:, g + k], out=table[1 << k : 2 << k])
        tables.append(table)
    return tables


def bit_planes(vectors):
    """(planes, vectors, groups) bytes of the two's complement, the sign plane last."""
    top = max((int(max(vectors.max(), ~vectors.min())) if vectors.size else 0), 0).bit_length()
    bits = ((vectors >> b) & 1 for b in range(top + 1))
    return [np.packbits(x.astype(np.uint8), axis=1, bitorder="little") for x in bits]


def scores(tables, planes, n_vectors, n_anchors, kind):
    """Inner products (vectors, anchors). The tables' integers must hold the sums of a plane."""
    total = np.zeros((n_vectors, n_anchors), kind)
    if not tables:
        return total
    plane, sums = np.empty((2, n_vectors, n_anchors), tables[0].dtype)
    for b in range(len(planes) - 1, -1, -1):
        for g, table in enumerate(tables):
            # A byte is never beyond its table; this mode alone writes without a copy.
            table.take(planes[b][:, g], axis=0, out=sums if g else plane, mode="clip")
            if g:
                plane += sums
        if b == len(planes) - 1:
            total -= plane  # the sign plane
        else:
            total += total
            total += plane
    return total


def _kind(anchors, vectors):
    """The narrowest integers that hold all sums on the way to a score."""
    if anchors.dtype == object or vectors.dtype == object:
        return object
    largest = float(np.abs(anchors).max(initial=0)) * anchors.shape[1] * 4.0 * (float(np.abs(vectors).max(initial=0)) + 1)
    return np.int32 if largest < 2.0**31 else np.int64 if largest < 2.0**62 else object


def _narrow(anchors, kind):
    """The narrowest integers that hold the sums of any subset of an anchor's components."""
    if kind is object:
        return object
    return np.int16 if np.abs(anchors).sum(axis=1).max(initial=0) < 2**15 else kind


class Best:
    """The best `n` (score, id) of each of `groups` groups, higher scores first, then smaller ids."""

    def __init__(self, groups, n):
        self.groups, self.n, self.steps, self.settled = groups, n, 0, 0
        self.empty = np.zeros(0, np.int64)
        self.group, self.score, self.id = self.empty, self.empty, self.empty
        self.least = np.full(groups, -(2**62), object).astype(np.int64)  # the score of the last of a full group
        self.last = np.full(groups, NO_ID)
        self.new, self.waiting = [], 0

    def add(self, group, score, ids):
        """Rows wait until there are as many as the groups hold, so that sorting costs little for each of them."""
        fits = (score > self.least[group]) | ((score == self.least[group]) & (ids <= self.last[group]))
        self.new.append((group[fits], score[fits], ids[fits]))
        self.waiting += len(self.new[-1][0])
        if self.waiting >= self.groups * self.n:
            self.settle()

    def settle(self):
        if not self.waiting:
            return
        group, score, ids = (np.concatenate(x) for x in zip((self.group, self.score, self.id), *self.new))
        self.new, self.waiting, self.settled = [], 0, self.settled + 1
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.searchsorted(group, np.arange(self.groups))
        place = np.arange(len(group)) - first[group]
        kept = place < self.n
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]
        full = self.group[place[kept] == self.n - 1]
        self.least[full], self.last[full] = self.score[place[kept] == self.n - 1], self.id[place[kept] == self.n - 1]


def _steps(best, spans):
    """Parts of the spans, which grow with the steps that were made for these anchors."""
    for at, to in spans:
        while at < to:
            end = min(to, at + STEPS[min(best.steps, len(STEPS) - 1)])
            best.steps += 1
            yield at, end
            at = end


def _as(kind, bounds):
    """Bounds as integers of the scores' kind; no score is the least or greatest of its kind."""
    return bounds if kind is object else np.clip(bounds, np.iinfo(kind).min, np.iinfo(kind).max).astype(kind)


def _search(vectors, block, bands, n):
    """FOUND rows of one pass over the vectors.

    block: (vec_ids, labels, matrix) of anchors, sorted by label. Without bands, the best n rows of an anchor's label
    (positive 0). bands: (positives, lowest, highest) lists of an anchor's positives; the best n rows of other labels with a
    score in between.
    """
    ids, labels, matrix = block.value

    def run(batches):
        spread = bands.value if bands is not None else None
        width = 1 if spread is None else spread[0].shape[1]
        starts = range(0, len(ids), TABLE_ANCHORS)
        best, tables = {a: Best(min(TABLE_ANCHORS, len(ids) - a) * width, n) for a in starts}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = batch.column("label").to_numpy(zero_copy_only=False)
            order = np.argsort(kinds, kind="stable")
            kinds = kinds[order]
            there = batch.column("vec_id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)[order]
            all_rows = integers(batch.column("embedding"), matrix.shape[1])
            kind = _kind(matrix, all_rows)
            planes = bit_planes(all_rows[order, : matrix.shape[1]])
            for a in starts:
                z = min(a + TABLE_ANCHORS, len(ids))
                begin, end = np.searchsorted(kinds, labels[a], "left"), np.searchsorted(kinds, labels[z - 1], "right")
                if spread is None:
                    spans = [(begin, end)]
                else:
                    spans = [(0, begin), (end, len(kinds))] if labels[a] == labels[z - 1] else [(0, len(kinds))]
                if all(i == j for i, j in spans):
                    continue
                if (a, kind) not in tables:
                    own = matrix[a:z]
                    made = subset_tables(own.astype(_narrow(own, kind)))
                    if sum(t.nbytes for x in tables.values() for t in x) + sum(t.nbytes for t in made) > TABLE_BYTES:
                        tables.clear()  # tables of many anchors are made anew for each batch
                    tables[a, kind] = made
                settled = None
                for i, j in _steps(best[a], spans):
                    found = scores(tables[a, kind], [x[i:j] for x in planes], j - i, z - a, kind)
                    if settled != best[a].settled:
                        settled, low, high = best[a].settled, best[a].least.reshape(-1, width), None
                        if spread is not None:
                            low, high = np.maximum(low, spread[1][a:z]), spread[2][a:z]
                            low = np.where(low > high, 2**62, low)  # nothing fits
                        least, most = _as(kind, low.min(axis=1)), None if high is None else _as(kind, high.max(axis=1))
                    # Few rows are within any of an anchor's bounds; these are tried with each of them.
                    hit = found >= least
                    if most is not None:
                        hit &= found <= most
                    at = np.flatnonzero(hit)
                    row, col = i + at // (z - a), at % (z - a)
                    fit = ((kinds[row] == labels[a + col]) == (spread is None)) & (there[row] != ids[a + col])
                    row, col, score = row[fit], col[fit], found.ravel()[at[fit]].astype(np.int64)
                    for p in range(width if len(row) else 0):
                        within = score >= low[col, p]
                        if high is not None:
                            within &= score <= high[col, p]
                        best[a].add(col[within] * width + p, score[within], there[row[within]])
        for a in starts:
            best[a].settle()
            if len(best[a].group):
                columns = a + best[a].group // width, (best[a].group % width).astype(np.int32), best[a].id, best[a].score
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])

    return vectors.mapInArrow(run, FOUND)


def _dealt(vectors, n_anchors):
    """The usable vectors; dealt out evenly and kept, if they lie in so few parts that most cores would have nothing to score."""
    parts = [r["count"] for r in vectors.groupBy(F.spark_partition_id()).count().collect()]
    cores, most = vectors.sparkSession.sparkContext.defaultParallelism, max(parts, default=0)
    if most * n_anchors <= TASK_PAIRS or most * cores <= 2 * sum(parts):
        return usable(vectors)
    return keep(usable(vectors).repartition(min(2 * cores, -(-sum(parts) * n_anchors // TASK_PAIRS))), "vectors")


def _ranked(found, n):
    """The best n of all tasks, with their rank."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _bands(block_size, rows, width, low, high):
    """(ids, lowest, highest score of a negative, positive scores), each a row for an anchor and a column for a positive."""
    ids = np.full((block_size, width), NO_ID)
    lowest, highest = np.full((block_size, width), 1), np.full((block_size, width), 0)  # nothing fits
    score = np.zeros((block_size, width), np.int64)
    for r in rows:
        at = r["anchor"], r["rank"] - 1
        ids[at], score[at] = r["found_id"], r["score"]
        lowest[at], highest[at] = -(-low * r["score"] // 100), high * r["score"] // 100
    return ids, lowest, highest, score


def hard_negatives(vectors: DataFrame, is_anchor, positives=5, negatives=10, low=30, high=90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors has vec_id, label, embedding; is_anchor is a condition on vec_id and label. A component x counts as
    floor(256 * x), a score is the inner product of these integers. An anchor's positives are the best `positives` other rows of its label.
    Its negatives for a positive are the best `negatives` rows of other labels whose score is between `low` and `high`
    hundredths of the positive's. Equal scores are ordered by vec_id.

    Rows without a label or a vector, or with a null, NaN or infinite component, take no part. Shorter vectors are filled with
    zeros. A vec_id names a vector: rows with an anchor's own vec_id are neither its positives nor its negatives. Other
    rows that repeat a vec_id each count; anchors that agree in everything count once. A null vec_id sorts last and is no anchor
    unless the condition says so. Scores must fit 62 bits. An empty table, or one without anchors, gives no rows. Further columns do not matter.
    """
    spark = vectors.sparkSession
    anchors = keep(usable(vectors).where(is_anchor).distinct(), "anchors")
    size, widest, n_anchors = anchors.agg(
        F.sum(8 * F.size("embedding") + 16), F.max(F.size("embedding")), F.count(F.lit(1))
    ).first()
    blocks = -(-(size or 0) // BLOCK_BYTES)
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(max(1, blocks))))
    vectors = _dealt(vectors, n_anchors)
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks):
        # One block of bounded size; the blocks follow each other.
        held = anchors.where(F.col("block") == b).orderBy("label", "vec_id", "embedding").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        ids = held.column("vec_id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        labels = held.column("label").combine_chunks().to_numpy(zero_copy_only=False)
        matrix = integers(held.column("embedding").combine_chunks(), widest)
        block = spark.sparkContext.broadcast((ids, labels, matrix))
        rows = _ranked(_search(vectors, block, None, positives), positives).collect()  # at most `positives` an anchor
        bands = _bands(len(ids), rows, positives, low, high)
        spread = spark.sparkContext.broadcast(bands)
        found = _ranked(_search(vectors, block, spread, negatives), negatives)
        known = [(i, p, int(ids[i]), int(bands[0][i, p]), int(bands[3][i, p])) for i in range(len(ids)) for p in range(positives)]
        pairs = spark.createDataFrame(known, "anchor long, positive int, anchor_id long, positive_id long, positive_score long")

        def named(c):
            return F.nullif(F.col(c), F.lit(int(NO_ID))).alias(c)

        found.join(F.broadcast(pairs), ["anchor", "positive"]).withColumnRenamed("found_id", "negative_id").select(
            named("anchor_id"), named("positive_id"), "rank", named("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
