import datetime

from pyspark.sql import functions as F

from chatterscope.operators import aggregates, ranking


def test_dedupe_keeps_newest_and_one_without_id(posts):
    rows = posts(
        {"id": "a", "created_utc": 1, "fetched_at": 5, "score": 1, "text": "old"},
        {"id": "a", "created_utc": 2, "fetched_at": 1, "score": 2, "text": "new"},
        {"id": "b", "created_utc": 1, "fetched_at": 1, "score": 1, "text": "x"},
        {"id": "b", "created_utc": 1, "fetched_at": 2, "score": 0, "text": "y"},
        {"id": "c", "created_utc": 1, "fetched_at": 1, "score": 3, "text": "tie"},
        {"id": "c", "created_utc": 1, "fetched_at": 1, "score": 4, "text": "tie won"},
        {"id": None, "created_utc": 1, "text": "n1"},
        {"id": None, "created_utc": 2, "text": "n2"},
    )
    got = {(r["id"], r["text"]) for r in ranking.dedupe_posts(rows.repartition(5)).collect()}
    assert got == {("a", "new"), ("b", "y"), ("c", "tie won"), (None, "n2")}


def test_dedupe_cuts_hot_ids_before_the_shuffle(posts):
    plan = ranking.dedupe_posts(posts({"id": "a"}))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def _scored(spark, scores):
    rows = [("b", "2024", "01", str(i), s) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "brand string, year string, month string, id string, score int")


def test_monthly_top_keeps_ties(spark):
    scores = [i // 2 for i in range(50)] + [None, None]
    kept = ranking.monthly_top(_scored(spark, scores)).collect()
    assert len(kept) == 40 and min(r["score"] for r in kept) == 5


def test_monthly_top_ranks_null_scores_last(spark):
    kept = ranking.monthly_top(_scored(spark, [3, None, None, 1])).collect()
    assert len(kept) == 4
    kept = ranking.monthly_top(_scored(spark, [3, None, 1]), k=2).collect()
    assert sorted(r["score"] for r in kept) == [1, 3]


def test_monthly_top_against_dense_rank(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("brand"),
        F.lit("2024").alias("year"),
        (F.col("id") % 4).cast("string").alias("month"),
        "id",
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 45).cast("int")).alias("score"),
    )
    w = Window.partitionBy("brand", "year", "month").orderBy(F.col("score").desc_nulls_last())
    want = {r["id"] for r in df.withColumn("k", F.dense_rank().over(w)).where("k <= 20").collect()}
    assert {r["id"] for r in ranking.monthly_top(df).collect()} == want


def _daily(spark, days, brand="b"):
    rows = [(brand, datetime.date.fromisoformat(d), i + 1) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "brand string, event_date date, mentions long")


def test_rolling_mean_counts_rows_and_restarts_with_the_year(spark):
    days = [f"2024-12-{d:02d}" for d in (1, 2, 3, 10, 11, 20, 21, 22, 31)] + ["2025-01-01"]
    rolled = ranking.rolling_mean(aggregates.with_month(_daily(spark, days)), ["mentions"])
    got = [r["mentions_roll7"] for r in rolled.orderBy("event_date").collect()]
    want = [sum(range(max(1, i - 5), i + 2)) / min(i + 1, 7) for i in range(9)] + [10.0]
    assert got == want


def test_top_post_per_day(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        ("b", day, None, "1", "/x", "one"), ("b", day, None, "0", None, "zero"),
        ("c", day, 1, "2", "/y", "low"), ("c", day, 2, "3", "/z", "a\nb"),
    ]
    scored = spark.createDataFrame(
        rows, "brand string, event_date date, score int, id string, permalink string, text string"
    )
    got = {tuple(r) for r in ranking.top_post_per_day(scored).collect()}
    assert got == {("b", day, "", "zero"), ("c", day, "https://reddit.com/z", "a b")}
    daily = _daily(spark, ["2024-01-01", "2024-01-02"])
    joined = ranking.attach_top_post(daily, scored).orderBy("event_date").collect()
    assert [(r["top_permalink"], r["top_text"]) for r in joined] == [("", "zero"), ("", "")]


def test_limit_per_group_beyond_the_threshold(spark):
    df = spark.range(6000).withColumn("g", (F.col("id") % 3 == 0).cast("int")).repartition(7)
    for n in (10, 1500):
        kept = ranking.limit_per_group(df, ["g"], [F.col("id").desc()], n).collect()
        for g in (0, 1):
            ids = sorted((r["id"] for r in kept if r["g"] == g), reverse=True)
            assert ids == [i for i in range(5999, -1, -1) if (i % 3 == 0) == bool(g)][:n]


def test_monthly_top_shuffles_no_text(spark, tmp_path):
    df = _scored(spark, [3, 2, 2, 1]).withColumn("text", F.lit("some text"))
    df.write.parquet(str(tmp_path / "scored"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1)
    try:
        top = ranking.monthly_top(spark.read.parquet(str(tmp_path / "scored")))
        plan = top._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert top.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _text_travels(df):
    """Whether a shuffle below the last join of the plan carries texts."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    join = next(n for n in _nodes(plan) if n.nodeName().endswith("Join"))
    shuffles = [n for n in _nodes(join) if n.nodeName() == "Exchange"]
    assert shuffles
    return any("text#" in n.output().mkString(",") for n in shuffles)


def test_backfill_and_best_posts_shuffle_no_text(spark, posts, tmp_path):
    from chatterscope.operators.ingest import backfill_top

    rows = [{"id": str(i % 40), "subreddit": "a", "score": i % 7, "created_utc": i, "fetched_at": i, "text": "t" * i, "brand": f"b{i % 2}", "permalink": "/p"} for i in range(60)]
    posts(*rows).withColumn("event_date", F.date_from_unix_date((F.col("created_utc") % 3).cast("int"))).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    for frame, n in ((backfill_top(df, ["a"], 3), 3), (backfill_top(df, ["a", "all"], 3), 3), (ranking.top_post_per_day(df), 6)):
        assert not _text_travels(frame) and frame.count() == n


def test_backfill_of_equal_and_nameless_rows(posts):
    from chatterscope.operators.ingest import backfill_top

    row = {"subreddit": "a", "score": 5, "created_utc": 1, "fetched_at": 1, "text": "t"}
    named = [{**row, "id": "x"}] * 3 + [{**row, "id": "x", "fetched_at": 2, "score": 1}]
    nameless = [row] * 4 + [{**row, "score": 9}]
    got = backfill_top(posts(*named, *nameless), [" A "], 4).collect()
    assert sorted((r["id"] or "", r["score"], r["fetched_at"]) for r in got) == [("", 5, 1), ("", 5, 1), ("", 5, 1), ("", 9, 1)]
    got = backfill_top(posts(*named, *nameless), ["a", "all"], 10).collect()
    assert sorted((r["id"] or "", r["score"]) for r in got) == [("", 5)] * 4 + [("", 9), ("x", 1)]
    assert backfill_top(posts(), ["a"], 3).collect() == []
