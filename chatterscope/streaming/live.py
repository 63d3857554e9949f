"""The live view as a streaming query."""

import time

from pyspark.sql import Observation, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from chatterscope.functions.text import contains_any
from chatterscope.operators.live import (
    for_point,
    keep_last,
    live_point,
    live_since,
    low_relevancy,
    row_epoch,
    shortened,
    since,
    with_live_key,
)
from chatterscope.operators.scoring import lexicon_dict, live_rows
from chatterscope.operators.seen import LEVEL, SeenKeys
from chatterscope.schema import LIVE_POINT_SCHEMA

TICKS = (
    "since double, now double, track_start double, waterline double, gathered long, dropped long, mentions long, "
    f"levels array<struct<{LEVEL.replace(' ', ':').replace(',:', ',')}>>, stale array<string>"
)


def _beating(posts):
    """The stream with a row without a post every second, so that ticks without posts are run, too."""
    beats = posts.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    beats = beats.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in posts.schema.fields], F.lit(True).alias("_beat"))
    return posts.withColumn("_beat", F.lit(False)).unionByName(beats)


class _Memory:
    """What one tick leaves to the next: a row in the table of ticks, written when all else is done."""

    def __init__(self, spark, path, batch_id, now, track_start, expiry):
        self.spark, self.path, self.batch_id = spark, path, batch_id
        before = None
        if batch_id > 0:
            before = spark.read.schema(TICKS).parquet(f"{path}/tick={batch_id - 1}").first()
        if before is None:
            self.track_start, self.waterline, levels, self.stale = track_start if track_start is not None else now, None, [], []
        else:
            self.track_start, self.waterline, levels, self.stale = before["track_start"], before["waterline"], before["levels"], before["stale"]
        self.seen = SeenKeys(spark, expiry=expiry, levels=levels)

    def commit(self, epoch, now, waterline, gathered, dropped, mentions, seen):
        """The folders that the tick before last still needed are emptied afterwards, once no repeated tick can want them."""
        row = (float(epoch), float(now), float(self.track_start), waterline, gathered, dropped, mentions, [tuple(x) for x in seen.levels], seen.stale)
        self.spark.createDataFrame([row], TICKS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tick={self.batch_id}")
        seen.clear(self.stale)


def start_live(
    posts,
    points_path,
    checkpoint,
    keywords,
    lexicon,
    provider="lexicon",
    threshold=0.5,
    track_start=None,
    backfill_minutes=2,
    delay="1 hour",
    trigger="10 seconds",
    rules=None,
    clock=time.time,
    once=False,
    include_idle=False,
):
    """Append one point per tick to the table at `points_path`, and one row on the tick to `checkpoint`/ticks.

    A tick counts the rows fetched at or after the later one of two times: the latest fetch of the ticks before (at first, the start of the
    session), and the clock less `backfill_minutes`. Both are read again with each tick, and outlive the process: a query that goes on from its
    checkpoint goes on from its waterline, a new checkpoint starts a fresh session. A row that is dated ahead of the clock moves
    the waterline to the clock only. A post is counted once within `delay`, by its live_key.

    `include_idle` adds a point of zeros for each tick without posts; the query then has a second source, so it needs a checkpoint of its own, and runs
    until it is stopped. Rows of low relevancy that were dropped are counted in the row on the tick (see `read_ticks`). A repeated
    micro-batch replaces what it wrote.
    """
    spark = posts.sparkSession
    expiry = spark.range(1).select(F.expr(f"CAST(timestamp_seconds(0) + INTERVAL '{delay}' AS DOUBLE)")).first()[0]
    words = lexicon_dict(lexicon)  # read once, not with every tick
    words = lexicon if words is None else words
    idle = include_idle and not once
    stream = _beating(posts) if idle else posts
    matching = stream.where(contains_any("text", keywords) | F.col("_beat") if idle else contains_any("text", keywords))

    def tick(batch, batch_id):
        now = clock()
        memory = _Memory(batch.sparkSession, f"{checkpoint}/ticks", batch_id, now, track_start, expiry)
        epoch = live_since(memory.waterline, memory.track_start, now, backfill_minutes)
        rows = batch.where(~F.col("_beat")).drop("_beat") if idle else batch
        # Once they are scored, texts are only looked at for an excerpt.
        scored = shortened(live_rows(since(rows, epoch), provider, words, rules))
        low, at = low_relevancy(threshold), row_epoch(scored)
        counted = Observation()
        # All that the tick must know of its rows is counted while they are scored.
        scored = scored.observe(
            counted, F.count(F.lit(1)).alias("rows"), F.count("relevancy").alias("rated"), F.count_if(low).alias("low"),
            F.max(at).alias("latest"), F.max(F.when(~low, at)).alias("latest_high"),
        ).persist()
        last = fresh = None
        try:
            scored.count()
            found = counted.get
            rated = found["rated"] > 0
            raw = scored.where(~low_relevancy(threshold)) if rated else scored
            latest = found["latest_high"] if rated else found["latest"]
            dropped = found["low"] if rated else 0
            waterline = memory.waterline
            if latest is not None:
                base = waterline if waterline is not None else float(epoch)
                waterline = max(base, float(int(min(latest, now))))
            # Rows are ranked once; what was seen is looked up in several jobs.
            last = for_point(keep_last(with_live_key(raw))).persist()
            fresh = memory.seen.unseen(last, now).persist()
            mentions = fresh.count()
            if mentions:
                live_point(fresh, now, provider).write.mode("overwrite").parquet(f"{points_path}/tick={batch_id}")
            elif include_idle:
                zero = live_point(fresh, now, provider, idle=True)
                zero.write.mode("overwrite").parquet(f"{points_path}/tick={batch_id}")
            seen = memory.seen.added(fresh, now)
            memory.commit(epoch, now, waterline, found["rows"] - dropped, dropped, mentions, seen)
        finally:
            for kept in (fresh, last, scored):
                if kept is not None:
                    kept.unpersist()

    writer = matching.writeStream.option("checkpointLocation", checkpoint).foreachBatch(tick)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": trigger})).start()


def read_points(spark, points_path):
    """Points of all ticks so far."""
    stored = StructType([*LIVE_POINT_SCHEMA.fields, StructField("tick", LongType())])
    return spark.read.schema(stored).parquet(points_path).drop("tick")


def read_ticks(spark, checkpoint):
    """A row for each tick: tick, since, now, track_start, waterline, gathered, dropped, mentions."""
    names = ["tick", "since", "now", "track_start", "waterline", "gathered", "dropped", "mentions"]
    return spark.read.schema(f"{TICKS}, tick long").parquet(f"{checkpoint}/ticks").select(names)
