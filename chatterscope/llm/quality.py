"""Quality rules: a linear-chain conditional random field labels the lines of a text as content or boilerplate.

Lines are described by a few shares (symbols, capitals, repeats, ...). The field has two states, emission
weights and transitions, trained by gradient ascent on the log-likelihood (forward-backward) over the lines of a
bounded sample of documents with a quality label; each line takes the label of its document. Viterbi decoding
marks the lines of every text, and the share of words in content lines decides.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.batches import with_result
from chatterscope.llm.common import copied_if_small

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50

# Documents of the training sample, each with all of its lines: the bound of the classifier's sample.
SAMPLE_DOCS = 3000
CONTENT_SHARE = 0.5
N_FEATURES = 12


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of a text."""
    words = WORD.findall(text)
    word_chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    repeated = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > 50 * len(words)
    return len(words), word_chars, symbols, dup_lines, repeated, failed


def repeat_words(words):
    """Words in 3-word windows that are found twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = 1
    return sum(hit)


def line_features(text):
    """Words per line with a word, and a row of features for each."""
    sizes, rows, seen = [], [], set()
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        n, chars = len(words), sum(map(len, words))
        letters = sum(map(str.isalpha, line))
        upper = sum(map(str.isupper, line))
        digits = sum(map(str.isdigit, line))
        sizes.append(n)
        rows.append((
            1.0,
            min(1.0, n / 20),
            min(1.0, chars / n / 10),
            sum(line.count(c) for c in SYMBOLS) / n,
            line.count("!") / n,
            line.count("|") / n,
            upper / max(1, letters),
            digits / max(1, len(line)),
            1 - len(set(words)) / n,
            sum(map(str.__eq__, words, words[1:])) / n,
            float(line in seen),
            float(line.rstrip(SPACES)[-1:] in ".!?"),
        ))
        seen.add(line)
    return sizes, np.array(rows, np.float64).reshape(-1, N_FEATURES)


def viterbi(emission, transition):
    """Best states of a chain; emission [n, 2], transition [2, 2]."""
    (t00, t01), (t10, t11) = transition.tolist()
    back, a, b = [], 0.0, 0.0
    for e0, e1 in emission.tolist():
        from0, from1 = a + t00 < b + t10, a + t01 < b + t11
        back.append((from0, from1))
        a, b = (b + t10 if from0 else a + t00) + e0, (b + t11 if from1 else a + t01) + e1
    states, state = [], int(b > a)
    for step in reversed(back):
        states.append(state)
        state = int(step[state])
    return states[::-1]


def train_field(chains, labels, rounds=150, rate=0.5, decay=1e-3):
    """Weights [features, 2] and transitions [2, 2] from feature rows per chain and a label per chain.

    Gradient ascent with momentum over all chains at once; the first transition starts from a state of value 0. Lines are
    laid out by their place in the chain, the longest chains first, so that a place takes one step and no room is filled up.
    """
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains, y = [chains[i] for i in order], np.eye(2)[np.asarray(labels)[order]]
    sizes = np.array([len(c) for c in chains])
    active = (len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes[0]), side="right")).tolist()
    starts = np.cumsum([0, *active]).tolist()
    steps = list(zip(starts, active))
    chain = np.concatenate([np.arange(k) for k in active])
    place = np.repeat(np.arange(len(active)), active)
    # Where each line of a chain has been put, chain by chain.
    put = np.empty(len(chain), np.int64)
    put[(np.cumsum(sizes) - sizes)[chain] + place] = np.arange(len(chain))
    x = np.empty((len(chain), N_FEATURES))
    x[put] = np.concatenate(chains)
    later = np.arange(active[0], len(chain))
    before = np.array(starts)[place[later] - 1] + chain[later]
    seen_w, seen_t = x.T @ y[chain], np.diag((y * (sizes - 1)[:, None]).sum(0))
    weights, transition = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    speed_w, speed_t, lines = 0.0, 0.0, len(chain)
    for _ in range(rounds):
        e = x @ weights
        forward, backward = e.copy(), np.zeros_like(e)
        for (p, _), (s, k) in zip(steps, steps[1:]):
            forward[s : s + k] += np.logaddexp.reduce(forward[p : p + k, :, None] + transition, axis=1)
        for (p, _), (s, k) in zip(steps[-2::-1], steps[:0:-1]):
            ahead = e[s : s + k] + backward[s : s + k]
            backward[p : p + k] = np.logaddexp.reduce(transition + ahead[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward[: active[0]] + backward[: active[0]], axis=1)[chain]
        expected_w = x.T @ np.exp(forward + backward - total[:, None])
        ahead = (e + backward - total[:, None])[later]
        expected_t = np.exp(forward[before][:, :, None] + transition + ahead[:, None, :]).sum(0)
        grad_w = (seen_w - expected_w) / lines - decay * weights
        grad_t = (seen_t - expected_t) / lines - decay * transition
        speed_w, speed_t = 0.9 * speed_w + grad_w, 0.9 * speed_t + grad_t
        weights, transition = weights + rate * speed_w, transition + rate * speed_t
    return weights, transition


def train(docs: DataFrame, labels: DataFrame, sample=SAMPLE_DOCS):
    """(weights, transitions) from at most `sample` labelled documents, chosen by a hash of their id.

    labels(doc_id, quality 0/1): documents labelled twice take the larger label; null labels are ignored. Without a
    document of either label there is nothing to learn: all weights are 0 and every line counts as content.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    read = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    rows = read.join(copied_if_small(chosen, sample), "doc_id")

    def features(batches):
        for pdf in batches:
            found = [(int(y), line_features(t)[1]) for y, t in zip(pdf["label"], pdf["text"])]
            yield pd.DataFrame(
                [(y, x.astype(np.float32).tobytes()) for y, x in found if len(x)], columns=["label", "x"]
            )

    def fit(pdf):
        pdf = pdf.sort_values(["label", "x"])  # the same weights, whatever the order of arrival
        chains = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in pdf["x"]]
        w, t = train_field(chains, pdf["label"].to_numpy())
        return pd.DataFrame({"w": [w.ravel().tolist()], "t": [t.ravel().tolist()]})

    found = (
        rows.mapInPandas(features, "label int, x binary")
        .groupBy(F.lit(0).alias("all"))
        .applyInPandas(fit, "w array<double>, t array<double>")
        .collect()  # one row of 28 numbers
    )
    if not found:
        return np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    return np.array(found[0]["w"]).reshape(N_FEATURES, 2), np.array(found[0]["t"]).reshape(2, 2)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "content_share double, lines string, kept boolean"
)


def quality(docs: DataFrame, labels: DataFrame, share=CONTENT_SHARE, sample=SAMPLE_DOCS, name="quality", model=None):
    """docs with a struct column: the base counts, the share of words in content lines, the label of each line
    with a word (C or B) and the verdict.

    `model` is what `train` returns; without it, one is trained here. A null or empty text has no words and fails. Lines without a word have no label. All columns and rows stay; a
    column called `name` is replaced.
    """
    weights, transition = train(docs, labels, sample) if model is None else model

    def judge(texts):
        rows = []
        for text in texts:
            base = counts(text)
            sizes, x = line_features(text)
            states = viterbi(x @ weights, transition) if weights.any() else [1] * len(sizes)
            content = sum(n for n, s in zip(sizes, states) if s)
            part = content / base[0] if base[0] else 0.0
            rows.append((*base, part, "".join("BC"[s] for s in states), not base[5] and part >= share))
        return rows

    return with_result(docs, judge, SCHEMA, name)


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that pass; the same columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    judged = quality(rows, labels, model=train(docs, labels))
    return judged.where("quality.kept").select("row.*")
