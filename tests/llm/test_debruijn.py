import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import debruijn as D


def brute(rows, length):
    """The contract in plain Python; rows: (doc_id, text)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {p for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for p in range(i, i + length)}
        spans = [p for p in sorted(gone) if p - 1 not in gone]
        out.append((doc, len(w), len(gone), len(spans), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def run(frame, rows, length, parts=3):
    got = D.substring_dedup(frame(rows).repartition(parts), length).drop("spans").collect()
    return sorted((tuple(r) for r in got), key=str)


def text_of(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def passages(rng, n):
    """Texts with exact and near copies, shared passages, repeats inside and plain texts."""
    common, rows = [text_of(rng, k) for k in (9, 12, 13, 30, 80)], []
    for i in range(n):
        text = text_of(rng, rng.randrange(0, 60))
        if i % 3 == 0:
            text += "\n" + rng.choice(common) + " " + text_of(rng, rng.randrange(0, 20))
        if i % 7 == 0:
            text = f"{text}\t{text}"
        rows.append((i, rows[rng.randrange(i)][1] if i % 5 == 4 else text))
    return rows


@pytest.mark.parametrize("batch", [1 << 22, 900])
def test_agrees_with_brute_force(frame, rng, monkeypatch, batch):
    monkeypatch.setattr(D, "BATCH", batch)  # documents in one batch, and in many
    rows = passages(rng, 150)
    assert run(frame, rows, 12) == brute(rows, 12)


def test_few_words_make_branches(frame, rng, monkeypatch):
    monkeypatch.setattr(D, "BATCH", 300)
    rows = [(i, text_of(rng, rng.randrange(0, 70), 3)) for i in range(40)]
    assert run(frame, rows, 9) == brute(rows, 9)


def test_production_length(frame, rng):
    passage = text_of(rng, 36)
    rows = [(0, text_of(rng, 40) + " " + passage), (1, passage + " x"), (2, passage.split(" ", 2)[2]), (3, text_of(rng, 90))]
    want = brute(rows, 35)
    assert run(frame, rows, 35) == want and [r[2] for r in want] == [36, 36, 0, 0]


def test_odd_texts(frame, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "a b c d e"), (None, "a b c d e"), (None, None), (3, "b c d e x"), (3, "q r s t"), (3, "q r s t")]
    assert run(frame, rows, 4) == brute(rows, 4)
    assert run(frame, [], 4) == []
    assert run(frame, [(1, None), (2, "")], 4) == [(1, 0, 0, 0, ""), (2, 0, 0, 0, "")]


def test_one_text_on_many_rows(frame, rng):
    text = text_of(rng, 30)
    rows = [(i % 2, text) for i in range(300)] + [(5, "a " + text), (6, text_of(rng, 30))]
    assert run(frame, rows, 12, 7) == brute(rows, 12)


def test_spans_and_further_columns(frame, rng):
    text = text_of(rng, 14)
    df = frame([(0, "x " + text + " y"), (1, text)], "'z' AS kept").withColumns({"spans": F.lit(1), "doc": F.lit(2), "mark": F.lit(3)})
    got = {r["doc_id"]: r for r in D.substring_dedup(df, 12).collect()}
    assert got[0]["kept"] == "x y" and [tuple(s) for s in got[0]["spans"]] == [(1, 15)] and got[1]["kept"] == ""


def test_chains_have_no_branches(spark):
    steps = spark.createDataFrame(
        [(1, None, 2), (2, 1, 3), (3, 2, None), (1, None, 2), (2, 1, 3), (3, 2, 4), (4, 3, None), (4, None, None), (5, None, 5), (5, 5, None)],
        "whole long, before long, after long")
    assert sorted(tuple(r) for r in D.chains(steps).collect()) == [(1, 2), (2, 3)]


def test_hashes_of_long_runs_depend_on_the_words_alone(rng, monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 64)
    words = np.array([rng.randrange(1 << 40) for _ in range(500)], np.uint64)
    words[300:420] = words[7:127]
    for n in (1, 12, 31, 32, 33, 63, 64, 65, 100):
        start = np.array([7, 7 + 9, 300, 300 + 9, 200])
        a, b, c, d, e = D._sizes_hashed(words, start, np.full(5, n)).tolist()
        assert a == c and b == d and len({a, b, e}) == 3
        assert D._sizes_hashed(words[300:420], np.array([0]), np.array([n]))[0] == a
