import math

import numpy as np

from chatterscope.llm import toxicity as t


def plain(rows, labels, order, epochs):
    """FTRL-proximal, one coordinate at a time, on dictionaries; the bias is a coordinate without penalties."""
    z, n = {}, {}

    def weight(k):
        s, l1, l2 = z.get(k, 0.0), *((0.0, 0.0) if k == "bias" else (t.L1, t.L2))
        if abs(s) <= l1:
            return 0.0
        return -(s - math.copysign(l1, s)) / ((t.BETA + math.sqrt(n[k])) / t.ALPHA + l2)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            keys = [*rows[i].tolist(), "bias"]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[i]
            for k in keys:
                before = n.get(k, 0.0)
                n[k] = before + g * g
                z[k] = z.get(k, 0.0) + g - (math.sqrt(n[k]) - math.sqrt(before)) / t.ALPHA * w[k]
    return {k: weight(k) for k in z}


def test_weights_against_plain_code(rng):
    rows, labels = [], []
    for i in range(200):
        bad = i % 3 == 0
        rows.append(np.unique([rng.randint(0, 40) + 25 * bad for _ in range(rng.randint(1, 12))]).astype(np.int32))
        labels.append(float(bad))
    at, w, bias = t.ftrl(rows, np.array(labels), epochs=2)
    want = plain(rows, labels, np.random.default_rng(7), 2)
    assert abs(bias - want.pop("bias")) < 1e-3
    want = {k: x for k, x in want.items() if x}
    assert set(at.tolist()) == set(want) and len(want) < 66
    assert all(abs(want[k] - x) < 1e-3 for k, x in zip(at.tolist(), w.tolist()))
