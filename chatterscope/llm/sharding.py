"""Sharding by a k-d tree: nodes are split at weighted medians along their widest metadata dimension.

Dimensions are lang, source and n_chars, each mapped to [0, 2^31): numbers by their place between the least and the
greatest value, texts by a checksum. A row's key in a dimension is that coordinate followed by 31 hash bits of the
row, so that even rows with equal metadata (a source with a third of all rows) can be split anywhere. The weight is
the size in bytes, so shards hold near equal bytes.

Medians are found without sorting, those of all nodes of a level together: each pass sums the bytes of 1,024 intervals
per node (combined inside the map tasks), finds the interval that holds the median by running sums per node, and narrows it.
One row per node reaches the driver. The tree is data: arrays over its nodes, numbered as in a heap, which one
expression walks for each row. Plans do not grow with the leaves, only these arrays do (some 40 bytes a leaf).
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from chatterscope.llm.common import keep

DIMENSIONS = ("lang", "source", "n_chars")
BITS = 31
INTERVALS = 1024
# A median is placed once the bytes of its interval are at most this share of the node.
TOLERANCE = 1e-4
SLOT_ROWS = 20_000


def _row_hash():
    return F.xxhash64("doc_id", "text_crc32")


def coordinates(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and a key for each dimension; nulls have coordinate 0, missing columns are null."""
    have = dict(docs.dtypes)
    meta = [(F.col(c) if c in have else F.lit(None).cast("long")).alias(c) for c in DIMENSIONS]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = keep(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), *meta,
        ),
        "metadata",
    )
    numbers = [c for c, kind in rows.dtypes if c in DIMENSIONS and kind != "string"]
    bounds = rows.agg(*[f(c).cast("double").alias(f"{c}_{f.__name__}") for c in numbers for f in (F.min, F.max)]).first()
    tie = F.pmod(_row_hash(), F.lit(1 << BITS))
    keys = []
    for c in DIMENSIONS:
        if c in numbers:
            low, high = bounds[f"{c}_min"], bounds[f"{c}_max"]
            scale = ((1 << BITS) - 1) / (high - low) if low is not None and high > low else 0.0
            at = F.floor((F.col(c).cast("double") - (low or 0.0)) * scale)
        else:
            at = F.shiftrightunsigned(F.crc32(F.col(c).cast("binary")), 1)
        keys.append((F.coalesce(at.cast("long"), F.lit(0)) * (1 << BITS) + tie).alias(f"key_{c}"))
    return rows.select("doc_id", "size", "text_crc32", *keys)


def _constant(values):
    """An array<bigint> as one expression, which is parsed once, when it is folded to a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _at(values, place):
    """The value at a place, counted from 1; null beyond the ends."""
    return F.get(values, (place - 1).cast("int"))


class _Tree:
    """Nodes numbered as in a heap (root 1, children 2 n and 2 n + 1): the split dimension and key of each, and its leaves."""

    def __init__(self, leaves, dimensions):
        self.dimensions = dimensions
        self.depth = (leaves - 1).bit_length()
        size = 2 << self.depth
        self.split, self.cut = [0] * size, [0] * size  # a dimension counts from 1; 0 is a node without a split
        self.leaves = {1: (0, leaves)}  # node -> (first leaf, number of leaves)

    def open_nodes(self, level):
        """The nodes of a level that must be split, and their numbers of leaves."""
        return {n: k for n in range(1 << level, 2 << level) for k in [self.leaves.get(n, (0, 1))[1]] if k > 1}

    def divide(self, node, dimension, cut):
        self.split[node], self.cut[node] = self.dimensions.index(dimension) + 1, cut
        first, k = self.leaves[node]
        self.leaves[2 * node], self.leaves[2 * node + 1] = (first, k // 2), (first + k // 2, k - k // 2)

    def node_of(self, levels):
        """The node that a row has reached after so many levels."""
        if not levels:
            return F.lit(1).cast("long")
        split, cut = _constant(self.split[1 : 1 << levels]), _constant(self.cut[1 : 1 << levels])
        keys = F.array(*[f"key_{d}" for d in self.dimensions])

        def step(node, _):
            beyond = _at(keys, _at(split, node)) >= _at(cut, node)
            return F.when(_at(split, node) > 0, 2 * node + beyond.cast("long")).otherwise(node)

        return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1).cast("long"), step)

    def leaf_of(self):
        first = [self.leaves.get(n, (0, 0))[0] for n in range(1, len(self.split))]
        return _at(_constant(first), self.node_of(self.depth)).cast("int")


def _medians(rows, wanted, dimensions):
    """The key that leaves `target` bytes below it, for each node of a level.

    wanted: node -> (dimension, low, high, target, bytes). rows have a column `node`.
    """
    found, state = {}, {n: (d, lo, hi, target, 0, whole) for n, (d, lo, hi, target, whole) in wanted.items()}
    base, last = min(wanted), max(wanted)
    none = ("", 0, 0, 0, 0, 0)
    keys = F.array(*[f"key_{d}" for d in dimensions])
    while state:
        line = [state.get(n, none) for n in range(base, last + 1)]
        steps = {n: max(1, -(-(hi - lo) // INTERVALS)) for n, (_, lo, hi, *_rest) in state.items()}
        columns = {
            "d": [dimensions.index(x[0]) + 1 if x[0] else 0 for x in line],
            "low": [x[1] for x in line],
            "high": [x[2] for x in line],
            "step": [steps.get(n, 1) for n in range(base, last + 1)],
            # Bytes are whole numbers, so it is the same to reach the target or the next whole number.
            "left": [math.ceil(x[3]) - x[4] for x in line],
        }
        place = F.col("node") - (base - 1)
        values = [_at(_constant(v), place).alias(c) for c, v in columns.items()]
        looked = rows.where(F.col("node").between(base, last)).select("node", "size", keys.alias("keys"), *values)
        key = _at(F.col("keys"), F.col("d"))
        inside = looked.where(F.col("d") > 0).withColumn("key", key).where("key >= low AND key < high")
        sums = inside.groupBy("node", F.expr("(key - low) div step").alias("place")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.first("left").alias("left")
        )
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("place"))
        hits = (
            sums.withColumn("upto", upto)
            .where(F.col("upto") >= F.col("left"))
            .groupBy("node")
            .agg(F.min_by(F.struct("place", "bytes", "rows", "upto"), "place").alias("hit"))
            .collect()  # a row for each node
        )
        hits = {r["node"]: r["hit"] for r in hits}
        still = {}
        for n, (d, lo, hi, target, below, whole) in state.items():
            hit, step = hits.get(n), steps[n]
            if hit is None:
                found[n] = hi
                continue
            begin, below = lo + hit["place"] * step, below + hit["upto"] - hit["bytes"]
            if hit["rows"] == 1 or step == 1 or hit["bytes"] <= TOLERANCE * whole:
                nearer_end = target - below > below + hit["bytes"] - target
                found[n] = (begin + step) if nearer_end else begin
            else:
                still[n] = (d, begin, min(begin + step, hi), target, below, whole)
        state = still
    return found


def kd_shards(docs: DataFrame, target_bytes=None, shards=None, dimensions=DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row: `shards` leaves, or as many as `target_bytes` asks for.

    A node of k leaves is split into k // 2 and the rest, at the key that divides its bytes in that proportion, along
    the dimension in which its rows spread widest (the first such, where they are equal). Slots number the rows of a
    shard without gaps. Null texts have size 1 and the checksum of an empty text. Rows that agree in doc_id and text
    stay together. An empty table gives no rows.
    """
    rows = coordinates(docs)
    whole = rows.agg(F.sum("size")).first()[0] or 0
    leaves = shards or max(1, math.ceil(whole / target_bytes))
    tree = _Tree(leaves, dimensions)
    for level in range(tree.depth):
        ready = tree.open_nodes(level)
        placed = rows.withColumn("node", tree.node_of(level))
        bounds = [f(f"key_{d}").alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]
        spread = placed.groupBy("node").agg(F.sum("size").alias("bytes"), *bounds).collect()  # a row for each node
        spread = {r["node"]: r for r in spread}
        wanted = {}
        for n, k in ready.items():
            r = spread.get(n)
            if r is not None:
                d = max(dimensions, key=lambda d: (r[f"max_{d}"] >> BITS) - (r[f"min_{d}"] >> BITS))
                wanted[n] = (d, r[f"min_{d}"], r[f"max_{d}"] + 1, r["bytes"] * (k // 2) / k, r["bytes"])
        cuts = _medians(placed, wanted, dimensions) if wanted else {}
        for n in ready:
            tree.divide(n, wanted[n][0] if n in wanted else dimensions[0], cuts.get(n, 0))
    return _with_slots(rows.withColumn("shard", tree.leaf_of()), leaves)


def _with_slots(rows, leaves):
    """Numbers the rows of each shard: counts per hash bucket give each bucket its first slot, rows are ranked inside."""
    total = rows.count()
    buckets = max(4, math.ceil(total / leaves / SLOT_ROWS))
    rows = rows.select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(_row_hash(), F.lit(buckets)).alias("bucket")
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("shard").alias("f_shard"), F.col("bucket").alias("f_bucket"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
    )
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    same = (F.col("shard") == F.col("f_shard")) & (F.col("bucket") == F.col("f_bucket"))
    return (
        rows.withColumn("rank", rank)
        .join(first, same)
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"))
    )
