import random

from chatterscope.operators.seen import SeenKeys
from chatterscope.plans.live import live_tick

T0 = 1_730_000_000


def _keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "live_key string")


def _lines(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_many_ticks_against_a_set(spark):
    rng, known, seen, lines = random.Random(5), set(), SeenKeys(spark), []
    for t in range(16):
        names = [f"id:{rng.randrange(200)}" for _ in range(12)] + [f"new:{t}"]
        df = _keys(spark, [*names, None])
        left = seen.unseen(df)
        lines.append(_lines(left))
        assert sorted(r[0] or "" for r in left.collect()) == sorted([n for n in names if n not in known] + [""])
        seen = seen.added(df, T0 + t)
        seen.clear(seen.stale)
        known |= set(names)
        # Each level is at least twice as large as the next one.
        sizes = [x.rows for x in seen.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 8
    assert max(lines[1:]) <= lines[1]
    assert {r[0] for r in seen.keys().collect()} == known


def test_large_batches_shuffle(spark, monkeypatch):
    monkeypatch.setattr("chatterscope.functions.lookup.MAX_BROADCAST_ROWS", 1)
    seen = SeenKeys(spark).added(_keys(spark, ["a", "b"]), 1).added(_keys(spark, ["c"]), 2)
    assert sorted(r[0] for r in seen.unseen(_keys(spark, ["a", "c", "d", "d"])).collect()) == ["d", "d"]


def test_expiry(spark):
    seen = SeenKeys(spark, expiry=10).added(_keys(spark, ["a", "b", "c", "d"]), 0).added(_keys(spark, ["a"]), 8)
    df = _keys(spark, ["a", "b"])
    assert [r[0] for r in seen.unseen(df, 9).collect()] == []
    assert [r[0] for r in seen.unseen(df, 11).collect()] == ["b"]
    later = seen.added(_keys(spark, ["x", "y", "z"]), 12)
    assert {r[0] for r in later.keys().collect()} == {"a", "x", "y", "z"} and later.stale
    assert SeenKeys(spark, expiry=10, levels=later.levels).added(_keys(spark, []), 30).levels == []


def test_nothing_seen(spark):
    df = _keys(spark, ["a"])
    assert SeenKeys(spark).unseen(df) is df
    assert SeenKeys(spark).added(_keys(spark, []), 1).levels == []


def test_ticks_with_stored_keys(spark, posts):
    def row(i, at):
        return {"id": i, "fetched_at": at, "created_utc": at, "text": "a nike", "score": 1}

    seen, mentions = SeenKeys(spark), []
    for i, ids in enumerate((["a", "b"], ["b", "c"], ["a", "c"])):
        tick = live_tick(posts(*[row(x, T0 + i) for x in ids]), seen, T0, f"2024-11-01 00:00:{i:02}", ["nike"], {})
        mentions.append([r["mentions"] for r in tick.point.collect()])
        seen = tick.seen
        tick.scored.unpersist()
    assert mentions == [[2], [1], []]


def test_hits_are_not_measured_again(spark, monkeypatch):
    """Keys that were seen are some of the keys that are asked for, which are measured; a key may stand in several levels."""
    seen, measured = SeenKeys(spark), []
    for t, names in enumerate((["a", "b", "c", "d"], ["a"])):
        seen = seen.added(_keys(spark, names), t)
    monkeypatch.setattr("chatterscope.operators.seen.is_small", lambda df: measured.append(df) or True)
    left = seen.unseen(_keys(spark, ["a", "x", "x", None]))
    assert sorted(r[0] or "" for r in left.collect()) == ["", "x", "x"] and len(seen.levels) == 2 and len(measured) == 1
