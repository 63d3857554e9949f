"""Dropping repeated posts in a stream."""

import heapq
import time
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from chatterscope.session import bounded_batches

_SPREAD = 16
# Keys that a task remembers to drop their copies before the shuffle.
_RECENT = 10_000


def dedupe_stream(df, delay="1 hour", keys=("type", "id"), spread=False):
    """Each post once among those that arrive within `delay` of its first copy. State is bounded by time.

    The watermark is that of the arrival, the clock of the micro-batch, not of a column of the posts: old posts are
    not late, and a post that is dated ahead moves nothing. A copy that arrives later than `delay` counts anew.

    `spread` adds a round per task share before the final one, for streams in which one id may make
    up a large part of a micro-batch.
    """
    df = df.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    if spread:
        shared = df.withColumn("_share", F.spark_partition_id() % _SPREAD)
        df = shared.dropDuplicatesWithinWatermark([*keys, "_share"]).drop("_share")
    return df.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")


_SEEN = "names array<string>, times array<double>"


def dedupe_bounded(df, bound=100_000, keys=("type", "id"), shards=64, max_age=None, clock=time.time):
    """Each post once among the last `bound` ones, whatever the time between copies.

    Keys are dealt to `shards` shares by hash, each of which remembers its last `bound // shards` keys (one at least), in the order of their first
    arrival; of keys that arrive in one micro-batch, in the order of their names. When a share is full, the key that was seen first is
    forgotten first; a copy does not make its key younger. With `max_age` (seconds), older keys are forgotten, too, when their share
    gets posts; a share that gets none holds no more than its bound. Copies that follow closely are dropped before they are shuffled, so a hot key is no hot spot.
    The number of shares is fixed by the checkpoint. The session's batches of rows for Python are made small, since rows carry their texts.

    Spark holds what a share gets in a micro-batch, so shares get keys alone; the keys they let through meet their rows in a
    shuffle by key, of which a task holds its part. The rows are read twice from `df`, whose keys must not be random.
    """
    bounded_batches(df.sparkSession)
    limit, names = max(1, bound // shards), list(keys)
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in names]
    share, whole_key = F.pmod(F.xxhash64(*filled), F.lit(shards)), F.concat_ws("\x1f", *filled)

    def label(row):
        return "\x1f".join("\0" if pd.isna(v) else str(v) for v in row)

    def first_of(columns):
        # Only the keys become Python objects; texts stay in Arrow.
        def run(batches):
            recent = set()
            for batch in batches:
                new = []
                for key in zip(*(batch.column(c).to_pylist() for c in columns)):
                    new.append(key not in recent)
                    recent.add(key)
                yield batch if all(new) else batch.filter(pa.array(new))
                if len(recent) > _RECENT:
                    recent.clear()

        return run

    def remember(key, frames, state):
        now = float(clock())
        known = list(zip(*state.get)) if state.exists else []
        if max_age is not None:
            known = [(n, t) for n, t in known if t >= now - max_age]
        old, fresh = {n for n, _ in known}, set()
        # Rows leave as they come; only names are held until the end.
        for pdf in frames:
            labels = pd.Series([label(row) for row in pdf[names].itertuples(index=False)], pdf.index, dtype=object)
            unknown = np.array([n not in old and n not in fresh for n in labels], bool)
            new = ~labels.duplicated() & unknown
            fresh.update(labels[new])
            yield pdf[new].drop(columns="_share")
        known = (known + [(n, now) for n in sorted(heapq.nlargest(limit, fresh))])[-limit:]
        if known:
            state.update(tuple(map(list, zip(*known))))
        elif state.exists:
            state.remove()

    columns = df.columns

    def passed(batches):
        # Rows may come before their key; one row of a key leaves.
        through, held = set(), deque()
        for batch in batches:
            through.update(batch.filter(batch.column("_passed")).column("_key").to_pylist())
            held.append(batch.filter(pc.invert(batch.column("_passed"))))
        while held:
            batch, fits = held.popleft(), []
            for key in batch.column("_key").to_pylist():
                fits.append(key in through)
                through.discard(key)
            yield batch.filter(pa.array(fits, pa.bool_())).select(columns)

    named = df.select(*[F.col(c).cast("string").alias(c) for c in names])
    dealt = named.mapInArrow(first_of(names), named.schema).withColumn("_share", share)
    fresh = dealt.groupBy("_share").applyInPandasWithState(remember, named.schema, _SEEN, "append", "NoTimeout")
    fresh = fresh.select(whole_key.alias("_key"), F.lit(True).alias("_passed"))
    rows = df.withColumn("_key", whole_key)
    rows = rows.mapInArrow(first_of(["_key"]), rows.schema).withColumn("_passed", F.lit(False))
    return rows.unionByName(fresh, allowMissingColumns=True).repartition("_key").mapInArrow(passed, df.schema)
