"""Time the headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

import json
import os
import time

from checks import registry
from chatterscope.session import get_spark

HEADLINE = (
    "daily_aggregate",
    "w1_dedupe_posts",
    "w2_monthly_top",
    "w3_rolling_mean",
    "w4_top_post_per_day",
    "j1_match_brands",
    "j1_match_brands_join",
    "j4_add_hints",
    "x1_compound",
    "x1_compound_join",
    "x2_extract_brand",
    "x3_parse_response",
    "f8_filter_relevancy",
    "s10_backfill_top",
    "k2_daily_sink",
    "k3_tops_sink",
    "e4_brand_series",
    "a7_live_points",
    "t6_live_tick",
    "t2_windowed_batch",
    "t1_t2_windowed_sentiment",
    "t5_dedupe_stream",
    "e3_live_ingest",
)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = registry.load()
    spark.read.parquet(f"{sf}/documents.parquet").selectExpr("count(text)").collect()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
