"""Rows between the steps stay small however many vectors there are, and scores carry from tree to tree."""

from __future__ import annotations

import collections
import glob
import math

import numpy as np
import pyarrow.dataset as ds
import pyarrow.parquet as pq

from meterlens.config import checkpoint_dir
from meterlens.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def kept(spark):
    return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/meterlens-topk-*"))


def frame(spark, x, parts):
    return spark.createDataFrame([(i, v) for i, v in enumerate(x)], SCHEMA).repartition(parts)


def test_what_is_written_can_be_read_in_small_batches(spark):
    x = np.random.default_rng(3).normal(size=(6000, 64))
    before = kept(spark)
    got = topk.top_k(*(lambda df: (df, df.filter("vec_id % 1500 = 0")))(frame(spark, x.tolist(), 1)))
    at, = kept(spark) - before
    sizes = [len(v) for name in ("x", "t_x") if name in (t := ds.dataset(at).to_table()).column_names for v in t[name].to_pylist()]
    assert max(sizes) <= 1 << 16
    assert sum(sizes) >= 6000 * 64 * 2
    for f in glob.glob(f"{at}/*.parquet"):
        m = pq.ParquetFile(f).metadata
        assert all(m.row_group(i).num_rows <= 64 for i in range(m.num_row_groups))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan  # no pair of a tree and a block is ever a row
    assert got.count() == 20


def test_scores_carry_over_trees_tasks_and_number_types(spark, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 70)
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "PIECE", 400)
    rng = np.random.default_rng(11)
    scale = np.array([0.1, 1.0, 300.0, 4e4, 1e9, 1e16])[np.sort(rng.integers(0, 6, 700))]  # pieces of 1, 2, 4 and 8 bytes
    x = [(v * s).tolist()[:n] for v, s, n in zip(rng.normal(size=(700, 9)), scale, rng.integers(1, 10, 700))]
    x[5], x[350] = [], x[340]  # no components; a tie
    df = frame(spark, x, 5)
    got = collections.defaultdict(list)
    for r in topk.top_k(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ints, most = [[math.floor(256 * c) for c in v] for v in x], 2 ** 63 - 1
    want = {}
    for q in range(0, 700, 50):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in enumerate(ints) if i != q)[:5]
        want[q] = [(i, max(-most, min(most, -s))) for s, i in best]
    assert got == want
