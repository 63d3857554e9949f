import random

import numpy as np
import pyarrow as pa
import pytest

from chatterscope.functions import terms as T


@pytest.mark.parametrize("piece, pairs", [(1 << 20, 1 << 20), (7, 3)])
def test_index_against_brute_force(monkeypatch, piece, pairs):
    monkeypatch.setattr(T, "PIECE", piece)
    monkeypatch.setattr(T, "PAIRS", pairs)
    rng = random.Random(3)
    letters = "abé\U0001f600"
    for _ in range(40):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(20)]
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(40)] + ["", "a", "a"]
        column = pa.array(["skipped", *texts]).slice(1)
        found = T.TermIndex(words).find(*T.text_bytes(column))
        want = sorted((i, j) for i, t in enumerate(texts) for j, w in enumerate(words) if t and w and w in t)
        assert list(zip(*(x.tolist() for x in found))) == want


def test_no_terms_and_no_texts():
    for words, texts in (([], ["a"]), (["a"], []), ([""], [None, ""])):
        found = T.TermIndex(words).find(*T.text_bytes(pa.array(texts, pa.string())))
        assert [len(x) for x in found] == [0, 0]


def test_one_letter_many_times():
    words = ["a" * n for n in range(1, 60)]
    rows, terms = T.TermIndex(words).find(*T.text_bytes(pa.array(["a" * 30_000, "b", "a" * 10])))
    assert len(terms) == 59 + 10 and rows.tolist() == [0] * 59 + [2] * 10


def test_work_does_not_grow_with_the_terms_of_a_gram():
    """Many terms that share their grams: the candidates are what occurs, not all terms of a gram."""
    words = [f"ababababab{n:05d}" for n in range(20_000)]
    column = pa.array(["ababababab" * 50 + "00007 ababababab12345"] * 20)
    index, seen = T.TermIndex(words), []
    index._occurring = lambda keyed, start, *rest: seen.append(len(start)) or T.TermIndex._occurring(index, keyed, start, *rest)
    rows, terms = index.find(*T.text_bytes(column))
    assert len(rows) == 40 and sorted(set(terms.tolist())) == [7, 12345]
    assert sum(seen) < 100


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_filter_against_brute_force(monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rng = random.Random(5)
    letters = "abé\U0001f600"
    for _ in range(20):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(20)]
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(40)})
        bits, held = 20, np.zeros(1 << 14, np.uint64)
        for slot in T.filter_slots(pa.array(["", *words]).slice(1), bits).tolist():
            held[slot >> 6] |= np.uint64(1 << (slot & 63))
        filtered = T.TermFilter(held, [len(w.encode()) for w in words])
        offsets, data = T.text_bytes(pa.array(["skipped", *texts]).slice(1))
        row, begin, end = filtered.find(offsets, data)
        found = set(zip(row.tolist(), T.stretch_texts(data, begin, end).to_pylist()))
        want = {(i, w) for i, t in enumerate(texts) for w in words if t and w in t}
        assert want <= found and len(found - want) < 5
