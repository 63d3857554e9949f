"""Writing newline-delimited JSON."""


def write_backfill(df, path):
    """Append posts as NDJSON; writes nothing, not even a folder, when there are none.

    The rows are kept between the look and the write, so that they are worked out once.
    """
    df = df.persist()
    try:
        if df.isEmpty():
            return None
        df.write.mode("append").option("ignoreNullFields", "false").json(path)
        return path
    finally:
        df.unpersist()


def start_ndjson_sink(df, path, checkpoint, flush="5 seconds", max_batch=200, once=False):
    """Write a stream as NDJSON files of at most `max_batch` records.

    Files become visible with the commit of their micro-batch. `once` handles what is there and stops.
    """
    writer = (
        df.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_batch)
        .option("ignoreNullFields", "false")
    )
    trigger = {"availableNow": True} if once else {"processingTime": flush}
    return writer.trigger(**trigger).start()
