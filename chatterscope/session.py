"""Session defaults and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app_name="chatterscope", master=None, **conf):
    """A session with UTC dates and adaptive execution; everything else is left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming state may outgrow the heap of an executor.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Rows that Spark hands to Python at once; texts may be long, and the buffers of a batch lie outside the heap.
BATCH_ROWS = 1000


def bounded_batches(spark, rows=BATCH_ROWS):
    """Lowers the session's limit of rows per Arrow batch, if it is higher."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def pin_utc(spark):
    """Calendar dates must not depend on where the driver runs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark):
    """The folder all executors can reach. Only a local master may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = os.path.join(tempfile.gettempdir(), "chatterscope-checkpoints")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark, name):
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/chatterscope/{name}-{uuid.uuid4().hex}"
