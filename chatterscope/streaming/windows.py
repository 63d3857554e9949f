"""Watermarked tumbling windows over a stream of scored posts."""

from pyspark.sql import functions as F

from chatterscope.functions.times import event_ts
from chatterscope.operators.aggregates import exact_mean
from chatterscope.operators.ranking import limit_per_group
from chatterscope.operators.scoring import score_posts
from chatterscope.operators.tagging import explode_brands, tag_posts


def score_stream(posts, lexicon, rules=None, scorer=None, cfg=None, tables=None):
    """Time and sentiment of streamed posts. With `cfg` or keyword `tables`, brands are tagged; by default
    the brand that the producer noted is kept.
    """
    dated = posts.withColumn("event_ts", event_ts("created_utc"))
    if cfg is None and tables is None:
        return score_posts(dated, lexicon, rules, scorer)
    return explode_brands(score_posts(tag_posts(dated, cfg, tables), lexicon, rules, scorer))


def windowed_sentiment(scored, window="1 minute", delay="2 minutes"):
    """Mentions and mean score per window, brand and sentiment. Also runs on a batch."""
    return (
        scored.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", window).alias("w"), "brand", "sentiment")
        .agg(F.count(F.lit(1)).alias("mentions"), exact_mean("compound").alias("avg_compound"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "brand",
            "sentiment",
            "mentions",
            "avg_compound",
        )
    )


def table_sink(path, **options):
    """A sink that keeps every micro-batch in its own folder, so a repeated batch replaces itself. `options` are the writer's."""

    def write(batch, batch_id):
        batch.write.mode("overwrite").options(**options).parquet(f"{path}/batch={batch_id}")

    return write


def latest_updates(updates, keys=("window_start", "brand", "sentiment")):
    """The last update of each key, from the table that `table_sink` wrote."""
    return limit_per_group(updates, keys, [F.col("batch").desc()], 1).drop("batch")


def start_window_query(df, sink="console", checkpoint=None, trigger="10 seconds", once=False):
    """Start a query in update mode. `sink` is a format name or a function (batch, batch_id)."""
    writer = df.writeStream.outputMode("update")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    if sink == "console":
        writer = writer.option("truncate", False)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": trigger})).start()
