import pytest
import json

from pyspark.sql import functions as F

from checks import views as V
from chatterscope.functions.sentiment import Rules
from chatterscope.operators.clean import clean_posts, filter_year
from chatterscope.plans.batch import daily_from_posts, run_batch, scored_posts
from chatterscope.plans.serving import brand_series
from chatterscope.sinks.files import write_backfill
from chatterscope.sources import tables
from chatterscope.sources.posts import read_posts, read_posts_lenient
from test_tagging import CFG

LEXICON = {"good": 1.9, "bad": -2.5}


def _line(i, created, text, **more):
    return {"id": str(i), "type": "comment", "subreddit": "tech", "created_utc": created, "text": text,
            "score": i, "fetched_at": created + 5, "permalink": f"/p/{i}", **more}


JAN, FEB, OLD = 1704153600, 1706832000, 1672531200


def _ingest(tmp_path):
    lines = [
        _line(1, JAN, "a good\n\niphone", unknown=1),
        _line(2, JAN + 60, "bad nike and apple launch"),
        _line(3, FEB, "nike"),
        _line(4, OLD, "apple of last year"),
        _line(5, JAN, "nothing"),
        # A newer version without a brand hides an older one with a brand.
        _line(6, JAN, "apple"),
        _line(6, JAN + 1, "pear"),
    ]
    folder = tmp_path / "ingest"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    return str(folder)


def test_batch_job(spark, tmp_path):
    base = run_batch(spark, _ingest(tmp_path), str(tmp_path / "out"), CFG, LEXICON, year=2024)
    posts = {(r["id"], r["brand"]): r for r in tables.read_posts_table(spark, base).collect()}
    assert set(posts) == {("1", "apple"), ("2", "apple"), ("2", "nike"), ("3", "nike")}
    first = posts["1", "apple"]
    assert (first["year"], first["month"], first["day"]) == ("2024", "01", "02")
    assert (first["text"], first["sentiment"], first["event_hit"]) == ("a good iphone", "positive", False)
    assert posts["2", "nike"]["event_tags"] == ["launch"] and posts["2", "nike"]["event_hit"]
    daily = {(r["brand"], str(r["event_date"])): r for r in tables.read_daily(spark, base).collect()}
    apple = daily["apple", "2024-01-02"]
    assert (apple["mentions"], apple["positive"], apple["negative"], apple["max_score"]) == (2, 1, 1, 2)
    assert (apple["event_hits"], apple["event_posts"], apple["month"]) == (1, 1, "01")
    for r in daily.values():
        assert r["positive"] + r["negative"] + r["neutral"] == r["mentions"]
    assert tables.read_tops(spark, base).count() == 4
    series = brand_series(spark, base, "nike", "2024").collect()
    assert [(r["mentions"], r["mentions_roll7"], r["top_permalink"]) for r in series] == [
        (1, 1.0, "https://reddit.com/p/2"), (1, 1.0, "https://reddit.com/p/3"),
    ]


def test_direct_daily_equals_the_job(spark, tmp_path):
    source = _ingest(tmp_path)
    base = run_batch(spark, source, str(tmp_path / "out"), CFG, LEXICON)
    stored = tables.read_daily(spark, base).drop("year", "month")
    direct = daily_from_posts(read_posts(spark, source), CFG, LEXICON)
    columns = sorted(stored.columns)
    assert sorted(map(tuple, stored.select(columns).collect())) == sorted(
        map(tuple, direct.select(columns).collect())
    )


def test_direct_daily_shuffles_no_text(spark):
    plan = daily_from_posts(V.posts(spark, "/root/testdata/sf0.001"), CFG, LEXICON, rules=Rules())
    shuffles = [
        line for line in plan._jdf.queryExecution().executedPlan().toString().split("\n")
        if "WindowGroupLimit" in line or "hashpartitioning" in line
    ]
    assert len(shuffles) == 4 and not any("text#" in line for line in shuffles)


def test_rows_without_brand_leave_their_text_behind(spark, posts):
    rows = posts(_line(1, JAN, "nothing"), _line(2, JAN, "apple"))
    plan = scored_posts(rows, CFG, LEXICON)._jdf.queryExecution().optimizedPlan().toString()
    assert "END AS text#" in plan


def test_result_does_not_depend_on_partitioning(spark, posts):
    rows = posts(*[_line(i % 40, JAN + i % 7, f"apple good {i}" if i % 2 else "bad nike") for i in range(200)])
    results = [
        sorted(map(str, scored_posts(rows.repartition(n), CFG, LEXICON).drop("text_hash").collect()))
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_missing_tables_are_empty(spark, tmp_path):
    assert tables.read_daily(spark, str(tmp_path)).count() == 0
    assert tables.read_tops(spark, str(tmp_path)).columns[-1] == "brand"
    assert tables.read_posts_for(spark, str(tmp_path), "2024-01-01", "b").count() == 0


def test_lookup_reads_one_folder(spark, tmp_path):
    base = run_batch(spark, _ingest(tmp_path), str(tmp_path / "out"), CFG, LEXICON)
    frame = tables.read_posts_for(spark, base, "2024-01-02", "nike")
    assert [r["id"] for r in frame.collect()] == ["2"]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len(frame.inputFiles()) >= 1


def test_year_filter_reaches_the_scan(spark, tmp_path, posts):
    posts(_line(1, JAN, "a")).write.parquet(str(tmp_path / "p"))
    plan = filter_year(spark.read.parquet(str(tmp_path / "p")), 2024)
    assert "GreaterThanOrEqual(created_utc,1704067200)" in plan._jdf.queryExecution().executedPlan().toString()


def test_year_limits(posts):
    rows = posts(_line(1, 1704067199, "a"), _line(2, 1704067200, "a"), _line(3, 1735689599, "a"),
                 _line(4, 1735689600, "a"), {"id": "5"})
    assert {r["id"] for r in filter_year(rows, "2024").collect()} == {"2", "3"}
    assert filter_year(rows).count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Kiritimati", "America/Sao_Paulo"])
def test_dates_do_not_depend_on_the_session_zone(spark, posts, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = (1704067199, 1704067200, 1704153599, -1, 0, 1541300400)
        rows = clean_posts(posts(*[_line(i, at, "a") for i, at in enumerate(times)])).orderBy("created_utc")
        got = [tuple(r) for r in rows.selectExpr("CAST(event_date AS STRING)", "year", "month", "day").collect()]
        assert got == [(f"{y}-{m}-{d}", y, m, d) for y, m, d in (("1969", "12", "31"), ("1970", "01", "01"), ("2018", "11", "04"),
                       ("2023", "12", "31"), ("2024", "01", "01"), ("2024", "01", "01"))]
        kept = clean_posts(filter_year(posts(*[_line(i, at, "a") for i, at in enumerate(times)]), 2024))
        assert {r["year"] for r in kept.collect()} == {"2024"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(_line(1, JAN, "x")) + "\n{broken\n")
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.txt").write_text(json.dumps(_line(2, JAN, "x")))
    (tmp_path / ".tmp_d.json").write_text(json.dumps(_line(3, JAN, "x")))
    assert [r["id"] for r in read_posts_lenient(spark, str(tmp_path)).collect()] == ["1"]


def test_backfill_writes_nothing_for_nothing(spark, tmp_path, posts):
    path = str(tmp_path / "backfill")
    assert write_backfill(posts(_line(1, JAN, "x")).where(F.lit(False)), path) is None
    assert not (tmp_path / "backfill").exists()
    assert write_backfill(posts(_line(1, JAN, "Über")), path) == path
    assert read_posts(spark, path).first()["text"] == "Über"


def test_texts_are_moved_once_for_all_brands_and_not_for_tops(spark, tmp_path, monkeypatch):
    from chatterscope.sinks import tables as sinks

    plans, write = {}, sinks._write

    def spied(df, path, *more):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().analyzed().toString()
        return write(df, path, *more)

    monkeypatch.setattr(sinks, "_write", spied)
    base = run_batch(spark, _ingest(tmp_path), str(tmp_path / "out"), CFG, LEXICON)
    posts, tops = plans["posts"], plans["top_posts_monthly"]
    assert posts.index("Generate explode(brands") < posts.index("RebalancePartitions")
    assert "RebalancePartitions" not in tops and tables.read_tops(spark, base).count() > 0
