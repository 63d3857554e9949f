"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words, pairs of neighbours, and pairs with one word between them,
hashed to 2^24 places. FTRL keeps for each place a sum of gradients and of their squares: rates per coordinate
and, by L1, weights of exactly 0 for all but a few places. Only the others are sent to the executors.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import copied_if_small
from chatterscope.llm.hashing import ROOT, byte_mask, mixed, sliced, text_bytes, word_hashes

BITS = 24
SEPARATORS = byte_mask((0, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

# The bound of the training sample: labelled documents, chosen by a hash of their id.
SAMPLE_DOCS = 20_000
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
EPOCHS = 12
SHARDS = 2


def places(words):
    """Places of all features of a text, repeats included."""
    pair, skip = np.uint64(0x51ED270B153A4D2F), np.uint64(0x8CB92BA72F3D8DD7)
    parts = [words, mixed(words[:-1] * pair + words[1:]), mixed(words[:-2] * skip + words[2:] * ROOT)]
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(rows, labels, epochs=EPOCHS):
    """(places, weights) that are not 0, and the bias, from arrays of distinct places and labels 0/1."""
    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(7)

    def weight(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0, w)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x, y = rows[i], labels[i]
            zx, nx = z[x], n[x]
            w = weight(zx, nx)
            b = -bias_z / ((BETA + bias_n**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - y
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA
            z[x] = zx + g - sigma * w
            n[x] = nx + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * b
            bias_n += g * g
    at = np.nonzero(np.abs(z) > L1)[0]
    return at, weight(z[at], n[at]), -bias_z / ((BETA + bias_n**0.5) / ALPHA)


def train(docs: DataFrame, labels: DataFrame, sample=SAMPLE_DOCS, shards=SHARDS):
    """(places, weights, bias): the mean of `shards` models, each trained in a task of its own on its share of at
    most `sample` labelled documents, read whole like those that are scored.

    labels(doc_id, toxic 0/1): documents labelled twice take the larger label; nulls are ignored. With nothing to
    learn from, weights and bias are 0 and every score is 0.5.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(copied_if_small(chosen, sample), "doc_id")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)))
    )

    def features(batches):
        for batch in sliced(batches):
            offsets, data = text_bytes(batch.column("text"))
            found = [
                np.unique(places(w)).astype(np.int32).tobytes()
                for _, w in word_hashes(offsets, data, SEPARATORS)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("label").cast(pa.int32()), pa.array(found, pa.binary())],
                ["shard", "label", "x"],
            )

    def fit(pdf):
        pdf = pdf.sort_values(["label", "x"])  # the same weights, whatever the order of arrival
        at, w, bias = ftrl([np.frombuffer(x, np.int32) for x in pdf["x"]], pdf["label"].to_numpy(float))
        return pd.DataFrame({"at": [at.tolist()], "w": [w.astype(float).tolist()], "bias": [float(bias)]})

    models = (
        rows.mapInArrow(features, "shard long, label int, x binary")
        .groupBy("shard")
        .applyInPandas(fit, "at array<int>, w array<double>, bias double")
        .collect()  # bounded by the features of the sample; L1 leaves few
    )
    mean = {}
    for m in models:
        for at, w in zip(m["at"], m["w"]):
            mean[at] = mean.get(at, 0.0) + w / len(models)
    at = np.array(sorted(mean), np.int64)
    bias = sum(m["bias"] for m in models) / len(models) if models else 0.0
    return at, np.array([mean[a] for a in at.tolist()], np.float32), bias


def score(docs: DataFrame, model, columns=("doc_id",), name="score") -> DataFrame:
    """The named columns and a score from 0 to 1 for every row of docs, over the whole text.

    A null or empty text has no features; its score is that of the bias alone.
    """
    at, weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((at, weights))
    columns = list(columns)
    schema = docs.select(*columns).schema.add(name, "double")

    def run(batches):
        dense = np.zeros(1 << BITS, np.float32)  # pages that hold only zeros take no memory
        dense[shared.value[0]] = shared.value[1]
        for batch in sliced(batches, column="_text"):
            offsets, data = text_bytes(batch.column("_text"))
            sums = np.zeros(batch.num_rows)
            for i, words in word_hashes(offsets, data, SEPARATORS):
                x = places(words)
                hit = np.unique(x[dense[x] != 0])
                sums[i] = dense[hit].astype(np.float64).sum()
            scores = 1 / (1 + np.exp(-np.clip(sums + bias, -35, 35)))
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], [*columns, name])

    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, schema)
