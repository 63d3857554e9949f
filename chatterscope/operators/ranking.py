"""Ranking within groups: dedupe, top-k, rolling means and the best post per day."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatterscope.functions.lookup import MAX_BROADCAST_ROWS, join_method
from chatterscope.functions.text import absolute_permalink, excerpt

_SPREAD = 64


def limit_per_group(df, by, order, n):
    """The first `n` rows of each group.

    Spark cuts each group inside the map tasks before the shuffle, so a hot group sends at most `n`
    rows per task. It does so only up to a threshold; beyond it, groups are first cut per task
    share and then as a whole.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in by]
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > threshold:
        share = df.withColumn("_share", F.spark_partition_id() % _SPREAD)
        window = Window.partitionBy(*by, "_share").orderBy(*order)
        df = (
            share.withColumn("_row", F.row_number().over(window))
            .where(F.col("_row") <= n)
            .drop("_row", "_share")
        )
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= n).drop("_row")


def marked(df):
    """df with two hashes of each whole row, by which the row can be found again."""
    return df.withColumns({"_m1": F.xxhash64(*df.columns), "_m2": F.xxhash64(F.lit(7), *df.columns)})


def fetched(df, keys, most=None):
    """The rows of `marked` df that are chosen in keys (_m1, _m2, _times), as often as they are chosen.

    Rows are chosen on what they are ranked by; their texts are read again where they lie. Keys are copied while they are known to be few
    (`most` rows of three numbers), or measured to be; the texts of rows that are not chosen are never shuffled.
    """
    small = most <= MAX_BROADCAST_ROWS if most is not None else join_method(keys) == "broadcast"
    found = df.join(keys.hint("broadcast" if small else "merge"), ["_m1", "_m2"])
    same = Window.partitionBy("_m1", "_m2").orderBy("_m1")
    return found.withColumn("_nth", F.row_number().over(same)).where("_nth <= _times").drop("_m1", "_m2", "_nth", "_times")


def chosen(rows):
    """keys for `fetched`, of chosen rows of a marked frame."""
    return rows.groupBy("_m1", "_m2").agg(F.count(F.lit(1)).alias("_times"))


def dedupe_order(df):
    """Newest version first; the rest only makes the choice among equals repeatable."""
    text_hash = F.col("text_hash") if "text_hash" in df.columns else F.xxhash64("text")
    return [
        F.col("created_utc").desc(),
        F.col("fetched_at").desc(),
        F.col("score").desc(),
        F.col("permalink").asc(),
        text_hash.asc(),
    ]


def dedupe_posts(df):
    """One post per id, the newest. Posts without an id count as one post."""
    return limit_per_group(df, ["id"], dedupe_order(df), 1)


def monthly_top(scored, k=20):
    """Posts with one of the `k` highest distinct scores of their brand and month.

    Ties make the result as large as the data allows, so the groups are not ranked row by row: the
    scores that qualify are found on their distinct values, and posts are kept by a join on them.
    The planner takes these keys for as large as the posts, so they are measured first: while they
    are small they are copied, and no post or text is shuffled. `scored` is read three times, twice
    in four columns only, so it should be a stored table.
    """
    group = ["brand", "year", "month"]
    scores = scored.select(*group, "score").distinct()
    best = limit_per_group(scores, group, [F.col("score").desc_nulls_last()], k)
    keys = best.select(*[F.col(c).alias(f"k_{c}") for c in [*group, "score"]])
    same = F.col("score").eqNullSafe(F.col("k_score"))
    for c in group:
        same = same & (F.col(c) == F.col(f"k_{c}"))
    return scored.join(keys.hint(join_method(keys)), same, "left_semi")


ROLLING_COLUMNS = ("mentions", "avg_compound", "positive", "negative", "neutral", "event_hits")


def rolling_mean(daily, cols=ROLLING_COLUMNS, n=7, date="event_date"):
    """Mean over the last `n` rows (not days) of a brand and year, as `<column>_roll<n>`."""
    window = Window.partitionBy("brand", "year").orderBy(date).rowsBetween(1 - n, 0)
    means = {f"{c}_roll{n}": F.avg(c).over(window) for c in cols if c in daily.columns}
    return daily.withColumns(means)


def top_post_per_day(posts):
    """The best post of each brand and day with its link and excerpt; only the texts of these posts are read and cleaned."""
    link = "permalink" if "permalink" in posts.columns else "url"
    rows = marked(posts.select("brand", "event_date", "score", "id", F.col(link).alias("link"), "text"))
    order = [F.col("score").desc_nulls_last(), F.col("id").asc(), F.col("_m1").asc(), F.col("_m2").asc()]
    best = fetched(rows, chosen(limit_per_group(rows, ["brand", "event_date"], order, 1)))
    return best.select(
        "brand", "event_date", absolute_permalink("link").alias("top_permalink"), excerpt("text").alias("top_text")
    )


def attach_top_post(daily, posts):
    """Daily rows with the best post of the day; empty strings where there is none."""
    return daily.join(top_post_per_day(posts), ["brand", "event_date"], "left").fillna(
        "", ["top_permalink", "top_text"]
    )
