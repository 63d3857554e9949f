"""Cases off the friendly path: repeats, mixed stamps, restarts, broken lines, odd scores."""

import json
import math

from pyspark.sql import functions as F

from chatterscope.operators.aggregates import exact_mean
from chatterscope.operators.ingest import backfill_top
from chatterscope.operators.scoring import score_by_join, score_posts
from chatterscope.schema import POST_SCHEMA
from chatterscope.sources.posts import read_posts_lenient, read_posts_stream
from chatterscope.streaming.live import read_points, start_live
from chatterscope.streaming.windows import start_window_query


def test_repeated_tokens_count_alike_in_both_forms(spark, posts):
    lexicon = spark.createDataFrame([("good", 2.0), ("good", -2.0)], "token string, valence double")
    df = posts({"id": "1", "text": "good day"})
    one = score_posts(df, lexicon).first()["compound"]
    assert one == score_by_join(df, lexicon).first()["compound"] and one < 0
    assert score_by_join(df, {"good": -2.0}).first()["compound"] == one


def test_mean_keeps_odd_scores(spark):
    df = spark.createDataFrame([(1.0,), (0.5,)], "x double")
    assert df.agg(exact_mean("x")).first()[0] == 0.75
    assert math.isnan(df.unionByName(spark.createDataFrame([(float("nan"),)], "x double")).agg(exact_mean("x")).first()[0])


def test_lenient_read_does_not_depend_on_columns(spark, tmp_path):
    lines = [{"id": "a", "created_utc": 1}, {"id": "b", "created_utc": {"x": 1}}, {"id": "c", "created_utc": 2}]
    (tmp_path / "x.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n\n{broken\n")
    df = read_posts_lenient(spark, str(tmp_path))
    assert df.count() == 2 and df.select("id").count() == 2 and len(df.select("id").collect()) == 2
    assert {r.id for r in df.collect()} == {"a", "c"} and df.columns == POST_SCHEMA.names
    assert read_posts_lenient(spark, str(tmp_path / "none")).count() == 0


def test_backfill_of_all_and_named_communities(spark):
    rows = [("1", "nike", 1), ("2", "Nike", 2), ("3", "other", 9), ("4", " NIKE", 3)]
    df = spark.createDataFrame(rows, "id string, subreddit string, score int").withColumn("created_utc", F.lit(5))
    ids = lambda subs, n: sorted(r.id for r in backfill_top(df, subs, n).collect())
    assert ids(["all", "nike"], 2) == ["2", "3", "4"] and ids(["nike"], 1) == ["4"] and ids(["all"], 1) == ["3"]


def _live(spark, folder, **options):
    posts = read_posts_stream(spark, f"{folder}/in")
    query = start_live(posts, f"{folder}/points", f"{folder}/check", ["thing"], {}, once=True, **options)
    query.awaitTermination(60)
    return [r.mentions for r in read_points(spark, f"{folder}/points").orderBy("ts").collect()]


def _post(number, at):
    return json.dumps({"id": str(number), "type": "comment", "text": "a thing", "created_utc": 100, "fetched_at": at}) + "\n"


def test_restart_counts_what_was_fetched_meanwhile(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(_post(1, 1_000_000))
    assert sum(_live(spark, tmp_path, clock=lambda: 1_000_000)) == 1
    (tmp_path / "in" / "2.json").write_text("".join(_post(n, 1_000_030) for n in (2, 3, 4)))
    assert sum(_live(spark, tmp_path, clock=lambda: 1_000_090)) == 4


def test_millisecond_stamps_do_not_silence_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(_post(1, 1_700_000_000_000))
    _live(spark, tmp_path, track_start=0, clock=lambda: 1_700_000_000)
    (tmp_path / "in" / "2.json").write_text("".join(_post(n, 1_700_000_010) for n in (2, 3, 4)))
    assert sum(_live(spark, tmp_path, track_start=0, clock=lambda: 1_700_000_020)) == 4


def test_window_query_without_a_checkpoint(spark, tmp_path):
    (tmp_path / "1.json").write_text(_post(1, 5))
    seen = []
    frame = read_posts_stream(spark, str(tmp_path)).groupBy("id").count()
    query = start_window_query(frame, lambda batch, number: seen.append(batch.count()), once=True)
    query.awaitTermination(60)
    assert seen == [1]
