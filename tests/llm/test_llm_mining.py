"""Hard-negative mining against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm.hard_negatives import hard_negatives

VECTORS = "vec_id long, embedding array<float>, label int, _key string, _w string, _block int"


def brute(rows, every=50):
    held = set()
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        held.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, label, w in held:
        if a % every:
            continue
        scored = sorted((-score(w, c), i, lab) for i, lab, c in held)
        positives = [(i, -s) for s, i, lab in scored if lab == label and i != a][:5]
        for p, ps in positives:
            negs = [(i, -s) for s, i, lab in scored if lab != label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, r, n, ps, ns) for r, (n, ns) in enumerate(negs, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [13, 10_000])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(8, 24))
    rows = []
    for i in range(400):
        v = base[i % 8] + 0.4 * rng.normal(size=24)
        rows.append((i, v.astype("float32").tolist(), int(rng.integers(0, 3))))
    rows += [(400 + i, rows[50][1], rows[50][2]) for i in range(6)]  # ties with an anchor's rows
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 24, 1), (503, [1.0] * 24, None)]
    rows += [(None, [1.0] * 24, 1), (550, [0.0] * 24, 2), (600, [], 1), (650, [1.0, 2.0], 0), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], VECTORS)
    got = hard_negatives(df, block_rows=block_rows)
    expected = brute(rows)
    assert len({r[:2] for r in expected}) > 20
    assert sorted(map(tuple, got.collect())) == expected


def test_hard_negatives_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives(empty).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, "", "", 0)], VECTORS)
    assert hard_negatives(one).count() == 0
