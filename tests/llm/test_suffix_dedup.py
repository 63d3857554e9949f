import hashlib

import pytest

from chatterscope.llm import suffix_dedup as sd


def brute(docs):
    first = {}
    order = sorted({(d is None, d or 0, t or "") for d, t in docs})
    for null, d, t in order:
        raw = t.encode()
        for i in range(len(raw) - 99):
            key = (null, d, i)
            first[raw[i : i + 100]] = min(first.get(raw[i : i + 100], key), key)
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if first[raw[i : i + 100]] < (d is None, d or 0, i):
                gone[i : i + 100] = b"\1" * 100
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, odd_texts):
    letters = "abcdefgh é日"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (60, 90, 99, 100, 101, 150, 400)]
    docs = []
    for i in range(150):
        parts = [text(rng.randint(0, 80)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(1, 6))]
        docs.append("".join(parts))
    docs += docs[:6] + [docs[3][:-1] + "Z", "ab" * 300, "a" * 250]
    return docs + odd_texts


@pytest.mark.parametrize("hot", [256, 3])
def test_against_brute_force(frame, rng, odd_texts, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    docs = [(i - 3, t) for i, t in enumerate(corpus(rng, odd_texts))]
    docs += [docs[4], docs[4], (None, docs[7][1]), (6, "x" * 20 + docs[11][1])]
    rng.shuffle(docs)
    got = sd.dedup(frame(docs, "1 AS mark").repartition(5)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(docs)


def test_batches_and_levels(frame, rng, odd_texts):
    docs = [(i, t) for i, t in enumerate(corpus(rng, odd_texts))]
    family, got = sd.SuffixFamily(), []
    for k in range(3):
        got += family.add(frame(docs[k * 60 : k * 60 + 60])).collect()
    assert [n for n, _, _ in family.levels] == [2, 1]
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(docs[:180])


def test_long_text_and_empty_table(frame, rng, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 1000)
    text = "".join(rng.choice("abcdef") for _ in range(3000))
    docs = [(1, text), (2, "zz" + text[500:2900] + "yy")]
    assert sorted((tuple(r)[:5] for r in sd.dedup(frame(docs)).collect()), key=str) == brute(docs)
    assert sd.dedup(frame([])).count() == 0
