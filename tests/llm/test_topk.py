from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from possum.llm import topk


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in {i: q for i, q in sorted(ok, reverse=True) if i % 50 == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in ok if i != qi and len(v) == len(q))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])]
    return sorted(out)


ODD = [(None, [1.0] * 6), (50, None), (100, [float("nan")] * 6), (150, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (7000, [1.0, None]),
       (7050, [1.0, 2.0]), (7100, []), (7150, []), (7200, [0.0] * 6), (50, [0.125] * 6), (9, [0.5] * 6), (9, [0.5] * 6)]


@pytest.mark.parametrize("kind", ["normal", "lengths", "copies", "huge"])
def test_exact(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 6))
    if kind == "lengths":
        x *= rng.lognormal(0, 1.5, (400, 1))
    if kind == "copies":  # near and exact copies: high cosines, many ties
        x = np.concatenate([x[:20] + (k % 3) * rng.normal(0, 0.02, (20, 6)) for k in range(20)])
    if kind == "huge":    # products beyond 2**53
        x *= 1e6
    rows = [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)] + ODD
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, query_block=5)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_coordinate_pruning_is_chosen_and_exact():
    rng = np.random.default_rng(1)
    v = np.tile(rng.normal(0, 1, (8, 16)), (60, 1)) + rng.normal(0, 0.01, (480, 16))
    v = np.floor(4096 * v / np.linalg.norm(v, axis=1, keepdims=True))
    v = v.astype(np.int64)
    ids, norms = np.arange(len(v)), np.sqrt((v.astype(float) ** 2).sum(axis=1))
    seen = []

    class Watched(topk.Search):
        def _by_coordinate(self, live, t, vectors, norms):
            out = super()._by_coordinate(live, t, vectors, norms)
            seen.append((len(out[1]), len(live) * len(vectors)))
            return out

    s = Watched(ids[:10], v[:10], norms[:10], 5)
    for at in range(0, len(v), 100):
        s.table({16: (ids[at:at + 100], v[at:at + 100], norms[at:at + 100])})
    for q in range(10):
        want = sorted((-int(v[q] @ v[j]), j) for j in range(len(v)) if j != q)[:5]
        assert list(zip(-s.score[s.owner == q], s.found[s.owner == q], strict=True)) == want
    assert seen and sum(a for a, _ in seen) < sum(b for _, b in seen)  # rows were left out


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(table, F.col("vec_id") % 50 == 0).collect() == []
