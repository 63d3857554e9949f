import json
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatterscope.operators.live import last_points
from chatterscope.operators.scoring import score_by_words
from chatterscope.operators.seen import SeenKeys
from chatterscope.schema import COMMENT_SCHEMA, POST_SCHEMA, SUBMISSION_SCHEMA
from chatterscope.sinks.files import start_ndjson_sink
from chatterscope.sources.posts import read_posts, read_posts_stream
from chatterscope.streaming.dedupe import dedupe_bounded, dedupe_stream
from chatterscope.streaming.ingest import start_ingest
from chatterscope.streaming.live import read_points, read_ticks, start_live
from chatterscope.streaming.windows import (
    latest_updates,
    score_stream,
    start_window_query,
    table_sink,
    windowed_sentiment,
)

LEXICON = {"good": 1.9, "bad": -2.5}
T0 = 1_704_067_200


class Feed:
    """A folder into which the test puts one file after another."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.path = str(tmp_path / "feed")
        (tmp_path / "feed").mkdir()
        self.files = 0

    def put(self, *rows):
        self.files += 1
        lines = "\n".join(json.dumps(r) for r in rows)
        path = self.root / "feed" / f"{self.files:04d}.json"
        path.write_text(lines)
        # Files are taken in the order of their times.
        os.utime(path, (T0 + self.files, T0 + self.files))

    def stream(self, max_files=None):
        return read_posts_stream(self.spark, self.path, max_files)

    def dir(self, name):
        return str(self.root / name)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def _post(i, at, text="good", **more):
    return {"id": str(i), "type": "comment", "brand": "b", "created_utc": at, "fetched_at": at, "text": text, **more}


def _updates(spark, feed):
    return spark.read.option("basePath", feed.dir("out")).parquet(feed.dir("out") + "/batch=*")


def _window_run(feed, max_files=None):
    query = windowed_sentiment(score_stream(feed.stream(max_files), LEXICON))
    return start_window_query(query, table_sink(feed.dir("out")), feed.dir("check"), once=True)


def test_windows_equal_the_batch(spark, feed):
    for start in (0, 90, 180):
        feed.put(*[_post(start + i, T0 + start + i, ["good", "bad", "x"][i % 3]) for i in range(90)])
        _window_run(feed).awaitTermination()
    got = latest_updates(_updates(spark, feed))
    want = windowed_sentiment(score_stream(read_posts(spark, feed.path), LEXICON))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert _updates(spark, feed).count() > want.count()


@pytest.mark.parametrize("advance,mentions", [(True, 1), (False, 2)])
def test_late_rows_are_dropped_one_batch_after_the_watermark(spark, feed, advance, mentions):
    """The watermark of a batch takes effect two batches later, within one run."""
    for at in [0, 600, *([601] if advance else []), 5]:
        feed.put(_post(at, T0 + at))
    _window_run(feed, max_files=1).awaitTermination()
    first = latest_updates(_updates(spark, feed)).where(F.col("window_start") == F.timestamp_seconds(F.lit(T0)))
    assert first.first()["mentions"] == mentions


def test_late_rows_are_dropped_after_a_restart(spark, feed):
    for at in (0, 600, 5):
        feed.put(_post(at, T0 + at))
        _window_run(feed).awaitTermination()
    first = latest_updates(_updates(spark, feed)).where(F.col("window_start") == F.timestamp_seconds(F.lit(T0)))
    assert first.first()["mentions"] == 1


@pytest.mark.parametrize("spread", [False, True])
def test_stream_dedupe(spark, feed, spread):
    feed.put(_post(1, T0), _post(1, T0), _post(2, T0), _post(1, T0, type="submission"))
    feed.put(_post(1, T0 + 5), _post(3, T0 + 5))
    dated = feed.stream(max_files=1).withColumn("event_ts", F.timestamp_seconds("created_utc"))
    unique = dedupe_stream(dated, "1 hour", spread=spread).select(*POST_SCHEMA.names)
    start_ndjson_sink(unique, feed.dir("out"), feed.dir("check"), once=True).awaitTermination()
    got = sorted((r["type"], r["id"]) for r in read_posts(spark, feed.dir("out")).collect())
    assert got == [("comment", "1"), ("comment", "2"), ("comment", "3"), ("submission", "1")]


@pytest.mark.parametrize("spread", [False, True])
def test_late_posts_and_a_post_dated_ahead_lose_nothing(spark, feed, spread):
    day = 86_400
    for at in (4_102_444_800, T0 + 9 * day, T0, T0 + day, T0 - 40 * day, None):
        feed.put(_post(at, at), _post("again", T0))
        unique = dedupe_stream(feed.stream(), spread=spread).select(*POST_SCHEMA.names)
        start_ndjson_sink(unique, feed.dir("out"), feed.dir("check"), once=True).awaitTermination()
    got = sorted(r["id"] for r in read_posts(spark, feed.dir("out")).collect())
    assert got == sorted(["again", "4102444800", "None", *(str(T0 + d * day) for d in (9, 0, 1, -40))])


def test_ingest_and_live_take_late_posts(spark, tmp_path):
    folders = {n: tmp_path / n for n in ("subs", "coms", "in")}
    for f in folders.values():
        f.mkdir()
    subs, coms = (read_posts_stream(spark, str(folders[n]), schema=s) for n, s in (("subs", SUBMISSION_SCHEMA), ("coms", COMMENT_SCHEMA)))
    total = 0
    for i, at in enumerate((4_102_444_800, T0, T0 - 900_000)):
        (folders["coms"] / f"{i}.json").write_text(json.dumps({"id": str(i), "created_utc": at, "body": "a nike"}) + "\n")
        (folders["in"] / f"{i}.json").write_text(json.dumps(_post(i, at, "a nike", fetched_at=T0 + i)) + "\n")
        start_ingest(subs, coms, ["nike"], str(tmp_path / "out"), str(tmp_path / "c1"), once=True).awaitTermination()
        start_live(
            read_posts_stream(spark, str(folders["in"])), str(tmp_path / "points"), str(tmp_path / "c2"), ["nike"], LEXICON,
            track_start=1, backfill_minutes=2, clock=lambda: T0 + i, once=True,
        ).awaitTermination()
    assert sorted(r["id"] for r in read_posts(spark, str(tmp_path / "out")).collect()) == ["0", "1", "2"]
    assert sum(r["mentions"] for r in read_points(spark, str(tmp_path / "points")).collect()) == 3


def test_ndjson_files_are_small(spark, feed):
    feed.put(*[_post(i, T0, "Über") for i in range(25)])
    query = start_ndjson_sink(feed.stream(), feed.dir("out"), feed.dir("check"), max_batch=10, once=True)
    query.awaitTermination()
    sizes = read_posts(spark, feed.dir("out")).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in sizes) == [5, 10, 10]
    raw = spark.read.text(feed.dir("out")).first()[0]
    assert "Über" in raw and '"permalink":null' in raw


def test_live_points(spark, feed):
    clock = iter([T0, T0 + 10, T0 + 20, T0 + 30, T0 + 40])
    for rows in (
        [_post("a", T0, "good nike"), _post("a", T0, "good nike"), _post("b", T0, "none")],
        [_post("a", T0 + 9, "good nike"), _post("c", T0 + 9, "bad nike", permalink="/c")],
        [_post("d", T0 + 19, "none")],
    ):
        feed.put(*rows)
        start_live(
            feed.stream(), feed.dir("points"), feed.dir("check"), ["nike"], LEXICON,
            track_start=T0, clock=lambda: next(clock), once=True,
        ).awaitTermination()
    points = last_points(read_points(spark, feed.dir("points"))).collect()
    assert [(r["mentions"], r["avg_compound"], r["top_permalink"]) for r in points] == [
        (1, -0.5423, "https://reddit.com/c"), (1, 0.4404, ""),
    ]
    assert read_points(spark, feed.dir("points")).count() == 2


def _view(feed, clock, **more):
    start_live(
        feed.stream(), feed.dir("points"), feed.dir("check"), ["nike"], LEXICON,
        **{"track_start": T0, "clock": lambda: clock, "once": True, **more},
    ).awaitTermination()
    return read_ticks(feed.spark, feed.dir("check")).orderBy("tick").collect()


def test_since_moves_with_every_tick(spark, feed):
    """Start, then the window, then the waterline; each tick is a process of its own on the checkpoint."""
    feed.put(_post("a", T0 - 1, "nike"), _post("b", T0, "nike"), _post("c", T0 + 5, "none"))
    assert _view(feed, T0 + 60)[-1]["since"] == T0
    feed.put(_post("d", T0 + 100, "nike"), _post("e", T0 + 880, "nike"), _post("f", T0 + 5000, "nike"))
    assert _view(feed, T0 + 1000)[-1]["since"] == T0 + 880
    feed.put(_post("g", T0 + 999, "nike"), _post("h", T0 + 1000, "nike"), _post("e", T0 + 1001, "nike"))
    ticks = _view(feed, T0 + 1010)
    assert [(r["since"], r["waterline"], r["gathered"], r["mentions"]) for r in ticks] == [
        (T0, T0, 1, 1), (T0 + 880, T0 + 1000, 2, 2), (T0 + 1000, T0 + 1001, 2, 1),
    ]


def test_rows_of_a_tick_are_ranked_once_with_short_texts(spark, feed, monkeypatch):
    """Looking up what was seen takes several jobs, so it gets kept rows; a text that is cut at a blank, a null one and none."""
    asked, lookup = [], SeenKeys.unseen

    def unseen(seen, df, now=None):
        asked.append((df.storageLevel.useMemory, "author" in df.columns, df.agg(F.max(F.length("text"))).first()[0]))
        return lookup(seen, df, now)

    monkeypatch.setattr(SeenKeys, "unseen", unseen)
    long = "nike" + "x" * 395 + " y" * 99
    for i, rows in enumerate(([_post("a", T0, "nike"), _post("a", T0, "nike")], [_post("a", T0, "nike"), _post("b", T0, long), _post("c", T0, None)], [])):
        feed.put(*rows, _post(f"none {i}", T0))
        _view(feed, T0 + i)
    assert asked == [(True, False, 4), (True, False, 464), (True, False, None)]
    points = last_points(read_points(spark, feed.dir("points"))).collect()
    assert [(r["mentions"], r["top_text"]) for r in points] == [(1, long[:400]), (1, "nike")]


def test_keys_are_forgotten_after_the_delay(spark, feed):
    for at in (T0, T0 + 50, T0 + 61, T0 + 400):
        feed.put(_post("a", at, "nike"))
        mentions = _view(feed, at, delay="60 seconds", backfill_minutes=60)[-1]["mentions"]
        assert mentions == (at != T0 + 50)


def test_repeated_tick_replaces_itself(spark, feed):
    for i in range(3):
        feed.put(_post(i, T0 + i, "nike"), _post(i + 1, T0 + i, "nike"))
        _view(feed, T0 + i)
    os.remove(feed.dir("check") + "/commits/2")
    os.remove(feed.dir("check") + "/commits/.2.crc")
    ticks = _view(feed, T0 + 2)
    assert [(r["tick"], r["mentions"]) for r in ticks] == [(0, 2), (1, 1), (2, 1)]
    assert read_points(spark, feed.dir("points")).count() == 3


def test_low_relevancy_is_counted_as_dropped(spark, tmp_path):
    rows = [(str(i), "a nike", T0, r) for i, r in enumerate(('{"compound": 1, "relevancy": 0.9}', '{"compound": 1, "relevancy": 0.1}', None))]
    schema = "id string, text string, fetched_at long, response string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    start_live(stream, str(tmp_path / "p"), str(tmp_path / "c"), ["nike"], LEXICON, provider="gemini", track_start=T0, clock=lambda: T0, once=True).awaitTermination()
    tick = read_ticks(spark, str(tmp_path / "c")).first()
    assert (tick["gathered"], tick["dropped"], tick["mentions"]) == (1, 2, 1)
    assert read_points(spark, str(tmp_path / "p")).first()["provider"] == "g"


def test_console_query_starts_and_stops(spark, feed):
    feed.put(_post(1, T0))
    query = start_window_query(windowed_sentiment(score_stream(feed.stream(), LEXICON)), checkpoint=feed.dir("check"))
    try:
        query.processAllAvailable()
        assert query.lastProgress["numInputRows"] in (0, 1) and query.exception() is None
    finally:
        query.stop()


def test_lexicons_of_any_size_can_be_streamed(spark, feed, monkeypatch):
    """More entries than a plan can hold, and a table that is measured as too large for a batch to copy."""
    words = {f"w{i}": 1.0 for i in range(60_000)} | LEXICON
    feed.put(_post(1, T0, "so good"), _post(2, T0, "w59999 bad"), _post(3, T0, "w1 w2"))
    table = spark.createDataFrame(list(words.items()), "token string, valence double")
    for lexicon, limit in ((words, 1_000_000), (table, 1_000_000), (table, 1)):
        monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", limit)
        out = f"{feed.dir('out')}{limit}{len(os.listdir(feed.root))}"
        scored = score_stream(feed.stream(), lexicon).select("id", "compound")
        start_window_query(scored, lambda batch, n: batch.write.mode("append").parquet(out), f"{out}-check", once=True).awaitTermination()
        got = {r["id"]: r["compound"] for r in spark.read.parquet(out).collect()}
        assert got == {r["id"]: r["compound"] for r in score_by_words(read_posts(spark, feed.path), table).collect()} and got["3"] > 0


def test_live_view_with_a_large_lexicon(spark, feed):
    feed.put(_post(1, T0, "good nike"), _post(2, T0, "w7 nike"))
    table = spark.createDataFrame([(f"w{i}", 1.0) for i in range(60_000)], "token string, valence double")
    start_live(feed.stream(), feed.dir("points"), feed.dir("check"), ["nike"], table, track_start=T0, clock=lambda: T0, once=True).awaitTermination()
    assert read_points(spark, feed.dir("points")).first()["avg_compound"] == pytest.approx(0.125)


def _remembered(files, limit):
    """What a share emits: files of ids, each id once while it is among the last `limit` that were seen first."""
    known, out = [], []
    for ids in files:
        fresh = sorted(set(ids) - set(known))
        out += fresh
        known = (known + fresh)[-limit:]
    return sorted(out)


@pytest.mark.parametrize("bound, shards", [(7, 1), (40, 1), (1000, 5)])
def test_dedupe_bounded_by_number(spark, feed, bound, shards):
    files = [[f"{(k * 5 + i) % 23:02}" for i in range(11)] for k in range(5)] + [["00", "00", "22"]]
    for ids in files:
        feed.put(*[_post(i, T0, score=None if i > "11" else 3) for i in ids])
    unique = dedupe_bounded(feed.stream(1), bound, shards=shards).select(*POST_SCHEMA.names)
    start_ndjson_sink(unique, feed.dir("out"), feed.dir("check"), once=True).awaitTermination()
    got = read_posts(spark, feed.dir("out")).collect()
    assert sorted(r["id"] for r in got) == _remembered(files, bound // shards)
    assert all(r["created_utc"] == T0 and r["score"] == (None if r["id"] > "11" else 3) for r in got)


def test_dedupe_bounded_by_age_and_after_a_restart(spark, feed):
    for at in (0, 50, 101):
        feed.put(_post("a", T0), _post("b", T0), _post(f"n{at}", T0), {"type": "comment", "text": "nameless"}, {"type": "comment", "text": "nameless"})
        unique = dedupe_bounded(feed.stream(), 100, shards=2, max_age=100, clock=lambda: T0 + at).select(*POST_SCHEMA.names)
        start_ndjson_sink(unique, feed.dir("out"), feed.dir("check"), once=True).awaitTermination()
    got = sorted(r["id"] or "" for r in read_posts(spark, feed.dir("out")).collect())
    assert got == ["", "", "a", "a", "b", "b", "n0", "n101", "n50"]


def test_dedupe_bounded_holds_no_rows_back(spark, monkeypatch):
    """A share gives the rows of a frame before it asks for the next one."""
    taken = {}
    monkeypatch.setattr(
        "pyspark.sql.pandas.group_ops.PandasGroupedOpsMixin.applyInPandasWithState",
        lambda self, run, *rest: taken.update(run=run) or spark.createDataFrame([], "type string, id string, text string"),
    )
    dedupe_bounded(spark.createDataFrame([], "type string, id string, text string"), 2, shards=1)

    class State:
        exists, get, held = False, None, None

        def update(self, value):
            self.held = value

    asked, state = [], State()

    def frames():
        for i in range(3):
            asked.append(i)
            yield pd.DataFrame({"type": "c", "id": [f"{i}", "same"], "text": "t", "_share": 0})

    rows = taken["run"]((0,), frames(), state)
    assert next(rows)["id"].tolist() == ["0", "same"] and asked == [0]
    assert [r["id"].tolist() for r in rows] == [["1"], ["2"]] and asked == [0, 1, 2]
    assert state.held[0] == ["c\x1f2", "c\x1fsame"]


def test_dedupe_bounded_gives_shares_keys_alone(spark, monkeypatch):
    """Spark holds all that a share gets, so texts go around it; copies in different batches of a task are dropped before."""
    runs, schemas = [], []
    monkeypatch.setattr("pyspark.sql.pandas.map_ops.PandasMapOpsMixin.mapInArrow", lambda self, run, *rest: runs.append(run) or self)
    monkeypatch.setattr(
        "pyspark.sql.pandas.group_ops.PandasGroupedOpsMixin.applyInPandasWithState",
        lambda self, run, schema, *rest: schemas.append(schema) or spark.createDataFrame([], "type string, id string, text string"),
    )
    dedupe_bounded(spark.createDataFrame([], "type string, id long, text string"), 2, shards=1)
    assert [[f.name for f in s.fields] for s in schemas] == [["type", "id"]]

    def batch(**columns):
        return pa.RecordBatch.from_pydict(columns)

    copies = [batch(type=["c", "c", None], id=["1", "1", None]), batch(type=["c", None, "s"], id=["1", None, "1"])]
    assert [b.to_pylist() for b in runs[0](iter(copies))] == [
        [{"type": "c", "id": "1"}, {"type": None, "id": None}], [{"type": "s", "id": "1"}]
    ]
    rows = batch(type=["c"] * 4, id=[1, 2, 1, 3], text=list("abcd"), _key=["k1", "k2", "k1", "k3"], _passed=[False] * 4)
    more = batch(type=[None, None, "c"], id=[None, None, 4], text=[None, None, "e"], _key=["k1", "k3", "k4"], _passed=[True, True, False])
    got = [r for b in runs[-1](iter([rows, more])) for r in b.to_pylist()]
    assert got == [{"type": "c", "id": 1, "text": "a"}, {"type": "c", "id": 3, "text": "d"}]


def test_dedupe_bounded_keys_of_other_types(spark, tmp_path):
    rows = [(1.5, None, 7, "a"), (1.5, None, 7, "b"), (None, True, None, "c"), (None, True, None, "d"), (float("nan"), False, 3, "e"), (None, None, 2, "f")]
    schema = "x double, y boolean, n int, text string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    unique = dedupe_bounded(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 100, keys=("x", "y"), shards=2)
    assert unique.schema == spark.createDataFrame([], schema).schema
    writer = unique.writeStream.option("checkpointLocation", str(tmp_path / "check")).foreachBatch(table_sink(str(tmp_path / "out")))
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()
    assert sorted((r["text"], r["n"]) for r in got) == [("a", 7), ("c", None), ("e", 3), ("f", 2)]
