import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pytest

from chatterscope.llm import pii, quality, sentencepiece as sp, toxicity
from chatterscope.llm.hashing import text_bytes, word_hashes

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def base_spans(text):
    return [(k, *m.span()) for k, (_, p, good) in enumerate(PLAIN) for m in re.finditer(p, text) if good(m[0])]


def test_pii_against_plain_patterns(frame, rng, odd_texts):
    bits = ["a", "@", ".", "b.c", "1", "23", ".4", "+1", "(", " ", "-", "4111111111111111", "256", "x@y.z", "é",
            "IBAN DE89370400440532013000", "https://u:p@h.com "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + odd_texts
    rows = pii.personal_data(frame(texts, "1 AS pii")).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for text, row in zip(texts, rows):
        want = base_spans(text or "")
        shown = ",".join(f"{PLAIN[k][0]}:{a}:{b}" for k, a, b in want)
        got = [x for x in row.pii.spans.split(",") if x and x.split(":")[0] in pii.BASE]
        assert ",".join(got) == shown and row.pii.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_pii_more_kinds_and_mask(frame):
    text = "Account no. 12345678, IBAN: DE89370400440532013000; ssh://joe:pw@host.example.org x@y.org"
    docs = frame([text, None, ""], "1 AS `row`")
    row = pii.personal_data(docs).orderBy("doc_id").first().pii
    assert "account:12:20" in row.spans and "login:" in row.spans
    masked = pii.mask_documents(docs)
    assert masked.columns == docs.columns
    texts = [r.text for r in masked.orderBy("doc_id").collect()]
    assert texts[1:] == [None, ""] and "12345678" not in texts[0] and "x@y.org" not in texts[0] and "<EMAIL>" in texts[0]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def test_quality_counts(rng, odd_texts):
    bits = ["a", "b ", "\n", "c ", "\x0b", "\x1c", " ", " d ", "# ", "a b c "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for text in texts + [t for t in odd_texts if t is not None]:
        assert quality.counts(text) == plain_counts(text)


def test_viterbi_is_the_best_path(rng):
    from itertools import product

    for _ in range(50):
        n = rng.randint(1, 7)
        e, t = np.random.default_rng(rng.randint(0, 10**6)).normal(size=(n, 2)), np.array([[1.0, -0.5], [-0.3, 0.8]])
        score = lambda s: sum(e[i, x] for i, x in enumerate(s)) + sum(t[a, b] for a, b in zip(s, s[1:]))
        got = quality.viterbi(np.vstack([e]), t)
        first = max(t[0, got[0]], t[1, got[0]])
        best = max(score(s) + max(t[0, s[0]], t[1, s[0]]) for s in product((0, 1), repeat=n))
        assert score(got) + first == pytest.approx(best)


def test_quality_learns_lines(spark, frame, rng):
    good = lambda: ". ".join(" ".join(rng.choice("alpha beta gamma delta eps".split()) + str(rng.randint(0, 999)) for _ in range(9)) for _ in range(9)) + "."
    bad = lambda: " | ".join(f"{rng.choice('PQRS')}{rng.randint(0, 999)}!! ##" for _ in range(60))
    texts = [good() if i % 2 else bad() for i in range(80)] + [None, ""]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(texts, "1 AS quality")
    kept = {r.doc_id for r in quality.drop_low_quality(docs, labels).collect()}
    assert kept == set(range(1, 80, 2))
    assert quality.drop_low_quality(docs, labels).columns == docs.columns
    untrained = quality.drop_low_quality(docs, labels.limit(0))
    assert {r.doc_id for r in untrained.collect()} >= kept and quality.drop_low_quality(frame([]), labels).count() == 0


@pytest.fixture(scope="module")
def vocab():
    return sp.load_vocabulary(VOCABULARY)


def best_score(word, vocab):
    best = [0.0] + [None] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            p = word[i:j]
            if p in vocab.usable and not (i and p[0] == sp.MARK):
                score = best[i] + vocab.scores[vocab.usable[p]]
            elif j == i + 1:
                score = best[i] + vocab.unknown
            else:
                continue
            best[j] = score if best[j] is None else max(best[j], score)
    return best[-1]


def test_pieces_are_the_best_ones(vocab, rng):
    words = [sp.MARK + "".join(rng.choice("thernotionäéß日▁.,7") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    for word, ids in zip(words, sp.encode_words(words, vocab)):
        for found in (ids, sp.encode_long(word, vocab)):
            letters = sum((vocab.raw[i][0] & 0xC0) != 0x80 for i in found if vocab.is_byte[i])
            score = sum(vocab.scores[i] for i in found if not vocab.is_byte[i]) + letters * vocab.unknown
            assert score == pytest.approx(best_score(word, vocab))


def test_round_trip(frame, vocab, odd_texts):
    docs = frame(odd_texts + [" lead", "two  spaces ", "a▁b ▁"], "1 AS ids")
    back = sp.decoded(sp.encoded(docs, vocab), vocab, name="again").orderBy("doc_id").collect()
    assert [r.again for r in back] == [r.text for r in back] and back[0].ids is None and back[1].ids == []
    assert all(r.pieces.round_trip for r in sp.digests(docs, vocab).where("text is not null").collect())


def test_toxicity_learns_and_keeps_rows(spark, frame, rng, odd_texts):
    text = lambda i: " ".join([f"w{rng.randint(0, 300)}" for _ in range(40)] + ["Vile", "slur"] * (i % 4 == 0))
    docs = frame([text(i) for i in range(400)] + odd_texts, "1 AS score")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == 400 + len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows if 300 <= r.doc_id < 400]
    assert sum(right) >= 97
    nothing = toxicity.score(docs, toxicity.train(docs, labels.limit(0))).first().score
    assert nothing == 0.5 and toxicity.score(frame([]), toxicity.train(docs, labels.limit(0))).count() == 0


def test_words_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    from chatterscope.llm import hashing

    texts = pa.array(["a bb " * 500, None, "x" * 3000, "", "tail É"])
    whole = {i: h.tolist() for i, h in word_hashes(*text_bytes(texts), toxicity.SEPARATORS)}
    monkeypatch.setattr(hashing, "CHUNK", 700)
    assert {i: h.tolist() for i, h in word_hashes(*text_bytes(texts), toxicity.SEPARATORS)} == whole


def test_quality_learns_from_lines_far_down(spark, frame):
    same = "\n".join(f"some plain line number {i}" for i in range(70))
    good, junk = ["\n".join([line] * 90) for line in ("A fine sentence with eight words in it.", "## ## || || !! !! ## ##")]
    docs = frame([f"{same}\n{junk if i % 2 else good}" for i in range(40)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    weights, transition = quality.train(docs, labels)
    for text, state in ((good, 1), (junk, 0)):
        _, x = quality.line_features(text)
        assert set(quality.viterbi(x @ weights, transition)) == {state}


def test_field_gradient_over_chains_of_any_length():
    r = np.random.default_rng(3)
    chains, labels = [r.random((n, quality.N_FEATURES)) for n in (1, 4, 2, 1, 3)], [0, 1, 1, 1, 0]
    lines = sum(map(len, chains))

    def likelihood(w, t):
        total = 0.0
        for x, y in zip(chains, labels):
            e = x @ w
            paths = list(itertools.product((0, 1), repeat=len(x)))
            worth = [sum(e[i, s] for i, s in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:])) for p in paths]
            total += worth[paths.index((y,) * len(x))] - np.logaddexp.reduce(worth)
        return total / lines

    weights, transition = quality.train_field(chains, labels, rounds=1, rate=1.0)
    zero_w, zero_t, d = np.zeros((quality.N_FEATURES, 2)), np.zeros((2, 2)), 1e-5
    for got, moved in ((weights, lambda at, by: likelihood(at * by, zero_t)), (transition, lambda at, by: likelihood(zero_w, at * by))):
        for place in np.ndindex(got.shape):
            at = np.zeros(got.shape)
            at[place] = 1
            assert abs(got[place] - (moved(at, d) - moved(at, -d)) / (2 * d)) < 1e-6


def test_toxicity_learns_from_words_far_down(spark, frame):
    clean = "some plain words here " * 1_100
    docs = frame([clean + ("vile slur " if i % 2 else "kind praise ") * 3 for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = [r.score for r in toxicity.score(frame(["vile slur", "kind praise"]), model).orderBy("doc_id").collect()]
    assert scores[0] > 0.5 > scores[1]
