"""Exact search for components of any finite size, and negative ids."""

from __future__ import annotations

import math

import numpy as np
import pytest

from meterlens.llm import topk


@pytest.mark.parametrize("scale", [1.0, 1e3, 4e4, 2e5, 1e9, 1e16])
def test_every_scale_against_brute_force(spark, scale):
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(160, 64)) * scale).astype(np.float32).astype(float)
    x[20] = x[10]  # a tie
    ids = [i - 55 for i in range(160)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(2)
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    ints = [[math.floor(256 * c) for c in v] for v in x.tolist()]
    most = 2 ** 63 - 1
    assert set(got) == {i for i in ids if i % 50 == 0}
    for q in got:
        want = sorted((-sum(a * b for a, b in zip(ints[q + 55], v)), i) for i, v in zip(ids, ints) if i != q)[:5]
        assert [got[q][k] for k in range(1, 6)] == [(i, max(-most, min(most, -s))) for s, i in want]
