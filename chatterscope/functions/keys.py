"""Row identity for the live view."""

from pyspark.sql import functions as F

from chatterscope.functions.text import strip_ws


def live_key(df):
    """First usable identity of a row: its id, its links, else time, place and author."""

    def col(name):
        return F.col(name) if name in df.columns else F.lit(None)

    def text(name):
        return F.coalesce(col(name).cast("string"), F.lit(""))

    def tagged(label, raw, shown):
        return F.when(strip_ws(raw) != "", F.concat(F.lit(label), shown))

    identity = F.concat(
        F.lit("ts:"),
        F.coalesce(col("created_utc").cast("string"), col("fetched_at").cast("string"), F.lit("")),
        F.lit(":sr:"),
        text("subreddit"),
        F.lit(":a:"),
        text("author"),
    )
    return F.coalesce(
        tagged("id:", text("id"), text("id")),
        tagged("permalink:", text("permalink"), strip_ws(text("permalink"))),
        tagged("url:", text("url"), strip_ws(text("url"))),
        identity,
    )
