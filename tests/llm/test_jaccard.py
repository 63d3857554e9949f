import re

import pytest

from chatterscope.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(docs):
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(docs))), [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    least = {}
    for (doc, _), r in zip(docs, root):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, len(s), least.get(r), n) for (d, _), s, r, n in zip(docs, sets, root, links)), key=str)


def near(rng, words, edits, names):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(names)
    return " ".join(words)


@pytest.mark.parametrize("block", [4, 128])
def test_against_brute_force(frame, rng, odd_texts, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    names = [f"w{i}" for i in range(400)]
    texts = list(odd_texts) + ["a b c", "A B\tc", "a b c d e", "a b c d", "É x y z q", "é x y z q"]
    passage = [rng.choice(names) for _ in range(60)]
    for size, members in ((80, 70), (40, 12), (300, 5), (12, 8), (6, 8)):
        base = [rng.choice(names) for _ in range(size)]
        texts += [near(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5]), names) for _ in range(members)]
    texts += [" ".join(passage + [rng.choice(names) for _ in range(rng.randint(0, 60))]) for _ in range(60)]
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    docs += docs[20:23] + [(5, docs[30][1]), (1000 - 40, "some other text entirely"), (None, "a b c")]
    rng.shuffle(docs)
    got = jaccard.near_copies(frame(docs, "1 AS mark")).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_one_of_each_group_stays(frame, odd_texts):
    long = " ".join(f"w{i}" for i in range(50))
    docs = frame([(3, long), (1, long.upper()), (2, long + " x"), (9, "other words"), (4, None), (4, ""), (3, long)], "1 AS a")
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 9]
    assert jaccard.drop_near_copies(frame([])).count() == 0


def test_repeated_and_null_ids_lose_no_other_text(frame):
    one, two, three = (" ".join(f"{c}{i}" for i in range(50)) for c in "abc")
    docs = frame([(None, one), (None, two), (None, one), (7, one), (7, two), (7, three), (7, three), (8, three),
                  (None, None), (None, None), (9, "")], "doc_id AS row")
    kept = [(r.doc_id, r.text) for r in jaccard.drop_near_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([(7, one), (7, two), (7, three), (None, None), (None, None), (9, "")], key=str)
