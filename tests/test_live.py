import datetime

import pytest
from pyspark.sql import functions as F

from chatterscope.operators import ingest, live
from chatterscope.plans.live import live_tick

LEXICON = {"good": 1.9, "bad": -2.5}
T0 = 1_730_000_000


def _row(i, at, text="a good nike", **more):
    return {"id": i, "fetched_at": at, "created_utc": at - 5, "text": text, "score": 1, **more}


@pytest.mark.parametrize(
    "last,start,now,minutes,want",
    [
        (None, 1000, 1030, 2, 1000), (None, 1000, 2000, 2, 1880), (1990, 1000, 2000, 2, 1990),
        (None, None, 2000, 0, 2000), (1000, 900, 2000, 60, 1000),
    ],
)
def test_since(last, start, now, minutes, want):
    assert live.live_since(last, start, now, minutes) == want


def test_row_time_falls_back(spark):
    df = spark.createDataFrame([("1730000000123", 1), ("junk", 7), (None, None)], "fetched_at string, created_utc long")
    assert [r[0] for r in df.select(live.row_epoch(df)).collect()] == [1730000000.0, 7.0, None]
    assert live.since(df, 8).count() == 1
    with pytest.raises(ValueError):
        live.row_epoch(spark.range(1))


def test_ticks_in_sequence(spark, posts):
    seen = spark.createDataFrame([], "live_key string")
    first = live_tick(
        posts(_row("a", T0), _row("a", T0 + 1, "bad nike", score=9), _row("b", T0), _row("c", T0, "none"),
              _row("old", T0 - 1)),
        seen, T0, "2024-11-01 00:00:00", ["Nike"], LEXICON,
    )
    point = first.point.first()
    assert (point["mentions"], point["avg_compound"], point["provider"]) == (2, pytest.approx((0.4404 - 0.5423) / 2), "v")
    assert point["top_text"] == "bad nike"
    assert first.waterline.first()[0] == T0 + 1
    assert {r[0] for r in first.seen.collect()} == {"id:a", "id:b"}
    second = live_tick(posts(_row("a", T0 + 2), _row("d", T0 + 3)), first.seen, T0 + 1, "2024-11-01 00:00:10", ["nike"], LEXICON)
    assert second.point.first()["mentions"] == 1
    third = live_tick(posts(_row("a", T0 + 4)), second.seen, T0 + 1, "2024-11-01 00:00:20", ["nike"], LEXICON)
    assert third.point.count() == 0


def test_tick_with_remote_answers(spark, posts):
    rows = posts(_row("a", T0), _row("b", T0), _row("c", T0)).withColumn(
        "response",
        F.when(F.col("id") == "a", '{"compound": 0.8, "relevancy": 0.9}').when(
            F.col("id") == "b", '{"compound": -0.8, "relevancy": 0.1}'
        ),
    )
    seen = spark.createDataFrame([], "live_key string")
    tick = live_tick(rows, seen, T0, "2024-11-01 00:00:00", ["nike"], LEXICON, provider="gemini")
    point = tick.point.first()
    assert (point["mentions"], point["avg_compound"], point["provider"]) == (1, 0.8, "g")


def test_top_one_by_compound_and_links(spark):
    df = spark.createDataFrame(
        [("1", 0.5, "", "u1", "x"), ("2", 0.9, None, "/u2", "y\nz")],
        "id string, compound double, permalink string, url string, text string",
    )
    assert tuple(live.top_one(df).first()) == ("https://reddit.com/u2", "y z")


def _points(spark, *rows):
    at = datetime.datetime(2024, 1, 1)
    full = [(at + datetime.timedelta(seconds=s), n, 0.5, link, "t" * 350, "v") for s, n, link in rows]
    return spark.createDataFrame(
        full, "ts timestamp, mentions long, avg_compound double, top_permalink string, top_text string, provider string"
    )


def test_points(spark):
    points = _points(spark, (0, 1, "a"), (20, 3, ""))
    assert live.latest_top(points).first()["top_permalink"] == "a"
    assert len(live.latest_top(points).first()["top_text"]) == 300
    assert live.with_permalink(points).count() == 1
    assert [r["mentions"] for r in live.last_points(points, 1).collect()] == [3]
    start = 1704067200
    filled = live.fill_idle_ticks(points, start, start + 20, 10).orderBy("ts").collect()
    assert [r["mentions"] for r in filled] == [1, 0, 3]
    assert live.fill_idle_ticks(points, start, start + 20, 10, include_idle=False).count() == 2


def test_backfill_of_all_and_of_some(posts):
    rows = posts(*[{"id": str(i), "subreddit": "A" if i % 3 else "b", "score": i, "created_utc": i} for i in range(12)])
    some = ingest.backfill_top(rows, [" a", "b"], 2, since=1, until=11).collect()
    assert sorted((r["subreddit"], r["score"]) for r in some) == [("A", 8), ("A", 10), ("b", 6), ("b", 9)]
    assert sorted(r["score"] for r in ingest.backfill_top(rows, ["all"], 2).collect()) == [10, 11]


def test_backfill_takes_the_version_fetched_last(posts):
    one = {"subreddit": "a", "created_utc": 5}
    rows = posts(
        {**one, "id": "x", "score": 9, "fetched_at": 1}, {**one, "id": "x", "score": 2, "fetched_at": 8}, {**one, "id": "x", "score": 4},
        {**one, "id": "y", "score": 5, "fetched_at": 3}, {**one, "id": "z", "score": 1, "fetched_at": 3}, {**one, "score": 3}, {**one, "score": 4},
    )
    for subs in (["a"], ["all"], ["all", "a"]):
        for n in (2, 4, 9):
            got = sorted(((r["id"], r["score"]) for r in ingest.backfill_top(rows, subs, n).collect()), key=lambda r: -r[1])
            assert got == [("y", 5), (None, 4), (None, 3), ("x", 2), ("z", 1)][:n]


def test_stamp(spark):
    df = spark.createDataFrame([(5,), (None,)], "created_utc long")
    got = ingest.stamp_fetched(df, 9).collect()
    assert [(r["created_utc"], r["fetched_at"]) for r in got] == [(5, 9), (9, 9)]
    assert ingest.stamp_fetched(df).where("fetched_at > 1700000000").count() == 2


def test_only_texts_that_become_the_best_are_cleaned(spark, monkeypatch):
    """A text that never leads is not cleaned: here that would raise an error."""
    clean = live.excerpt
    monkeypatch.setattr(live, "excerpt", lambda c: F.when(F.col(c) == "low", F.raise_error(F.lit("cleaned"))).otherwise(clean(c)))
    rows = [(1, "high", "p", 0.1, 2.0), (2, "low", "p", 0.1, 1.0)]
    df = spark.createDataFrame(rows, "id long, text string, permalink string, compound double, score double").coalesce(1)
    assert live.live_points(df, F.timestamp_seconds(F.col("score") * 0)).first().top_text == "high"


def test_points_of_shortened_texts_equal_points_of_texts(spark, posts):
    """Null and blank texts, texts that are cut at or after blanks, long blank ones, no score, no link, a key that comes twice, a null key."""
    ends = ["x" * 399 + " y" * 99, "x" * 399 + " " * 99 + "y", " \n" * 99 + "x" * 999, "\u2003" * 500 + "y" * 500, " " * 900, "é" * 999]
    texts = [None, "", " \n ", "\n a\nb ", "z", *ends, "x" * 390 + " " * 500]
    rows = posts(*[_row(str(i), T0, text, score=None if i == 2 else i % 4, url="" if i % 2 else f"/u{i}") for i, text in enumerate(texts)])
    rows = live.with_live_key(rows.unionByName(rows)).withColumn("compound", F.col("score") / 10)
    rows = rows.withColumn("live_key", F.when(F.col("id") != "1", F.col("live_key")))
    short = {r["id"]: r["text"] for r in live.shortened(rows).collect()}
    assert [len(short[str(i)] or "") for i in range(5, 12)] == [464, 499, 1197, 1000, 900, 464, 890] and short["0"] is None
    for df in (rows, rows.drop("score"), rows.drop("permalink", "url"), rows.drop("compound"), rows.where("false")):
        for tick in (F.lit(1), F.col("id")):
            want = live.live_points(df, tick).collect()
            assert sorted(map(str, live.live_points(live.shortened(df), tick).collect())) == sorted(map(str, want))
        narrow = live.for_point(live.shortened(df))
        assert "author" not in narrow.columns and live.live_points(narrow, F.lit(1)).collect() == live.live_points(df, F.lit(1)).collect()
