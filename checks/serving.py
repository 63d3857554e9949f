"""Checks of the slices behind a dashboard; they read the written tables."""

from pyspark.sql import functions as F

from checks import oracle as O
from checks.batch import DAILY_COLUMNS, joined, rounded, written
from checks.registry import query
from chatterscope.operators import serving
from chatterscope.plans.serving import brand_series
from chatterscope.sources.tables import read_daily, read_tops

_ROLL = "OVER (PARTITION BY brand, year ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@query("f5_slice_daily", O.select(O.DAILY, f"SELECT {DAILY_COLUMNS} FROM daily WHERE brand = 'src1' AND year = '2024'"))
def slice_daily(spark, sf):
    return rounded(serving.slice_daily(read_daily(spark, written(spark, sf)), "src1", "2024"))


@query(
    "f6_slice_tops",
    O.select(O.TOPS, "SELECT id, score, compound FROM tops WHERE brand = 'src2' AND year = '2024' AND month = '02'"),
)
def slice_tops(spark, sf):
    tops = serving.slice_tops(read_tops(spark, written(spark, sf)), "src2", "2024", "02")
    return tops.select("id", "score", "compound")


@query("a8_list_brands", O.select(O.DAILY, "SELECT DISTINCT brand FROM daily"))
def list_brands(spark, sf):
    return serving.list_brands(read_daily(spark, written(spark, sf)))


@query(
    "a9_list_years",
    O.select(O.DAILY, "SELECT year, year = max(year) OVER () AS is_latest FROM (SELECT DISTINCT year FROM daily)"),
)
def list_years(spark, sf):
    daily = read_daily(spark, written(spark, sf))
    latest = serving.latest_year(daily).scalar()
    return serving.list_years(daily).withColumn("is_latest", F.col("year") == latest)


@query(
    "a10_list_months",
    O.select(O.TOPS, """SELECT year, month, year || month = max(year || month) OVER () AS is_latest
    FROM (SELECT DISTINCT year, month FROM tops WHERE brand = 'src1')"""),
)
def list_months(spark, sf):
    return serving.list_months(read_tops(spark, written(spark, sf)), "src1")


@query(
    "p8_as_series",
    O.select(O.DAILY, "SELECT CAST(event_date AS TIMESTAMP) AS date, brand, mentions FROM daily"),
)
def as_series(spark, sf):
    return serving.as_series(read_daily(spark, written(spark, sf))).select("date", "brand", "mentions")


@query(
    "l1_order_series",
    O.select(O.DAILY, """SELECT CAST(event_date AS TIMESTAMP) AS date, mentions FROM daily
    WHERE brand = 'gamma' ORDER BY date"""),
)
def order_series(spark, sf):
    gamma = serving.slice_daily(read_daily(spark, written(spark, sf)), "gamma")
    return serving.order_series(serving.as_series(gamma)).select("date", "mentions")


_SHOWN = """score, event_ts, subreddit, compound, sentiment, tags,
  CASE WHEN permalink IS NULL THEN '' ELSE '[Open](' || permalink || ')' END AS link,
  md5(text) AS digest"""


def shown(tops):
    return (
        serving.select_display(tops)
        .withColumn("tags", joined("event_tags"))
        .withColumn("digest", F.md5("text"))
        .drop("event_tags", "text")
    )


@query("p9_display_columns", O.select(O.TOPS, f"SELECT {_SHOWN} FROM tops"))
def display_columns(spark, sf):
    return shown(read_tops(spark, written(spark, sf)))


@query(
    "l2_order_tops",
    O.select(O.TOPS, f"""SELECT {_SHOWN} FROM tops WHERE brand = 'src1' AND year = '2024'
    AND month = '01' ORDER BY score DESC NULLS LAST"""),
)
def order_tops(spark, sf):
    tops = serving.slice_tops(read_tops(spark, written(spark, sf)), "src1", "2024", "01")
    return shown(serving.order_tops(tops))


@query(
    "e4_brand_series",
    O.select(O.BEST + "," + O.DAILY.split("scored AS", 1)[1].split("),", 1)[1],
             f"""SELECT CAST(d.event_date AS TIMESTAMP) AS date, d.mentions,
             round(d.mentions_roll7, 8) AS mentions_roll7, round(d.compound_roll7, 8) AS avg_compound_roll7,
             b.top_permalink, b.top_text
             FROM (SELECT *, avg(mentions) {_ROLL} AS mentions_roll7, avg(avg_compound) {_ROLL}
                     AS compound_roll7 FROM daily) d
             JOIN best b ON d.brand = b.brand AND d.event_date = b.event_date
             WHERE d.brand = 'src2' AND d.year = '2024'"""),
)
def series(spark, sf):
    frame = brand_series(spark, written(spark, sf), "src2", "2024")
    return frame.select(
        "date",
        "mentions",
        F.round("mentions_roll7", 8).alias("mentions_roll7"),
        F.round("avg_compound_roll7", 8).alias("avg_compound_roll7"),
        "top_permalink",
        "top_text",
    )
