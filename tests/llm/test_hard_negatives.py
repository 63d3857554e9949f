import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>, score string"


def brute(rows, positives=5, negatives=10):
    """The contract in plain Python; rows: (vec_id, label, vector)."""
    fine = [(i, c, [int(np.floor(256 * x)) for x in v]) for i, c, v in rows
            if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    anchors = {(i, c, tuple(v)) for i, c, v in fine if i is not None and i % 4 == 0}
    for a, label, q in anchors:
        ranked = sorted((-sum(x * y for x, y in zip(q, v)), i is None, i or 0, c) for i, c, v in fine if i != a)
        for s, _, p, _ in [r for r in ranked if r[3] == label][:positives]:
            fits = [r for r in ranked if r[3] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, None if r[1] else r[2], -s, -r[0]) for k, r in enumerate(fits)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 4 == 0, **more).collect()), key=str)


def vectors(rng, n, dims=10):
    return [(i, rng.randrange(3), [rng.gauss(0.2, 1) for _ in range(dims)]) for i in range(n)]


def test_scores_are_exact(rng):
    a = np.array([[rng.randrange(-300, 300) for _ in range(24)] for _ in range(7)])
    v = np.array([[rng.randrange(-500, 500) for _ in range(24)] for _ in range(11)])
    for kind in (np.int32, np.int64, object):
        got = H.scores(H.subset_tables(a.astype(kind)), H.bit_planes(v), 11, 7, kind)
        assert (got == v @ a.T).all()


def test_huge_components_use_large_integers():
    lists = pa.array([[1e30, -1e30, 2.0], [1.0]], pa.list_(pa.float64()))
    m = H.integers(lists)
    assert m.dtype == object and m[0, 0] == int(np.floor(256 * 1e30)) and m[1, 2] == 0 and m.shape == (2, 8)


@pytest.mark.parametrize("steps", [(1, 3), (32, 128, 512)])
def test_agrees_with_brute_force(spark, rng, monkeypatch, steps):
    monkeypatch.setattr(H, "STEPS", steps)
    rows = vectors(rng, 90) + [(None, 1, [0.5] * 10), (7, 1, [0.25] * 10), (7, 1, [0.25] * 10), (4, 0, [0.1] * 10)]
    assert mined(spark, rows) == brute(rows)


def test_blocks_of_anchors(spark, rng, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_BYTES", 400)
    monkeypatch.setattr(H, "TABLE_ANCHORS", 2)
    rows = vectors(rng, 60)
    assert mined(spark, rows, positives=2, negatives=3) == brute(rows, 2, 3)


def searched(rows, bands, n):
    """One pass in this process; every fourth row is an anchor, anchors are sorted by label."""
    lists = pa.array([v for _, _, v in rows], pa.list_(pa.float64()))
    ids, labels = (np.array([r[k] for r in rows]) for k in (0, 1))
    chosen = np.flatnonzero(ids % 4 == 0)
    chosen = chosen[np.argsort(labels[chosen], kind="stable")]
    block = ids[chosen], labels[chosen], H.integers(lists)[chosen]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), lists], ["vec_id", "label", "embedding"])
    holder = lambda value: type("Held", (), {"value": value})
    frame = type("Frame", (), {"mapInArrow": lambda self, run, schema: list(run(iter([batch, batch])))})()
    return block, H._search(frame, holder(block), bands and holder(bands), n)


def test_a_pair_is_scored_in_one_pass_only(rng, monkeypatch):
    """Rows of an anchor's label in the first pass, the others in the second one, where anchors that share tables share a label."""
    rows = [(i, i // 64, [rng.gauss(0, 1) for _ in range(8)]) for i in range(256)]
    monkeypatch.setattr(H, "TABLE_ANCHORS", 16)
    pairs, scores = [], H.scores
    monkeypatch.setattr(H, "scores", lambda t, p, v, a, kind: pairs.append(v * a) or scores(t, p, v, a, kind))
    block, _ = searched(rows, None, 3)
    assert sum(pairs) == 2 * 64 * 64
    wide = np.full((64, 1), 0), np.full((64, 1), -(2**40)), np.full((64, 1), 2**40)
    searched(rows, wide, 3)
    assert sum(pairs) == 2 * 64 * 256


def test_rows_are_sorted_once_there_are_many(rng, monkeypatch):
    best, sorts, lexsort = H.Best(50, 10), [], np.lexsort
    monkeypatch.setattr(H.np, "lexsort", lambda keys: sorts.append(1) or lexsort(keys))
    rows = [(rng.randrange(50), rng.randrange(1000), i) for i in range(5000)]
    for i in range(0, 5000, 10):
        best.add(*(np.array(x) for x in zip(*rows[i : i + 10])))
    getattr(best, "settle", lambda: None)()
    ranked = sorted((g, -s, i) for g, s, i in rows)
    wanted = [r for k, r in enumerate(ranked) if k < 10 or ranked[k - 10][0] != r[0]]
    assert list(zip(best.group, -best.score, best.id)) == wanted and len(sorts) <= 10


def test_vectors_in_one_part_are_dealt_out(spark, rng, monkeypatch):
    monkeypatch.setattr(H, "TASK_PAIRS", 300)
    rows = vectors(rng, 90)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(1)
    used, search = [], H._search
    monkeypatch.setattr(H, "_search", lambda v, *more: used.append(v.rdd.getNumPartitions()) or search(v, *more))
    got = sorted((tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 4 == 0).collect()), key=str)
    assert got == brute(rows) and min(used) > 1


def test_one_vector_on_many_rows(spark, rng):
    rows = [(i, i % 2, [1.0, 0.5, 0.25]) for i in range(50)] + [(i, i % 3, [0.5, 0.5, 0.5]) for i in range(50, 60)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, 0, [1.0, 1.0]), (1, 0, [1.0]), (2, 1, [0.3, 0.3]), (3, 1, []), (4, None, [1.0, 1.0]), (5, 1, None),
        (6, 1, [None, 1.0]), (7, 1, [float("nan"), 1.0]), (8, 1, [float("inf"), 1.0]), (9, 0, [-1.0, 0.0]),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and got
    assert mined(spark, []) == []
    assert mined(spark, rows[1:4]) == []
