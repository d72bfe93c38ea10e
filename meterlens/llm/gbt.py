"""Gradient-boosted trees in numpy: logistic loss, histogram splits, monotonic
constraints, and scoring over flat node arrays.

A tree of depth D is a complete binary heap of ``2**(D+1)-1`` nodes (children
of node i: ``2i+1`` and ``2i+2``); a node with ``feature < 0`` is a leaf.
All trees share one array per field, so scoring a batch is ``trees * depth``
vectorised steps and no per-row Python.

``fit`` holds its rows in memory; ``fit_cells`` leaves them in Spark and sums
each level's histograms there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units of a gradient in the distributed sums: whole numbers add up alike in any order.
UNITS = float(1 << 28)


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray    # (trees, nodes) int32, -1 for a leaf
    threshold: np.ndarray  # (trees, nodes): go right when x > threshold
    value: np.ndarray      # (trees, nodes) leaf values
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                feat = f[at]
                right = x[rows, np.maximum(feat, 0)] > t[at]
                at = np.where(feat < 0, at, 2 * at + 1 + right)
            out += v[at]
        return out

    def proba(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int] | None = None, trees: int = 60,
        depth: int = 3, rate: float = 0.2, bins: int = 32, min_child: float = 2.0,
        l2: float = 1.0) -> Trees:
    """Newton boosting.  ``monotone[f]`` of +1 (-1) keeps the score from
    falling (rising) as feature f grows: a split that breaks it is refused,
    and both children are bounded by the mid-point of their values."""
    n, k = x.shape
    monotone = monotone or [0] * k
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(k)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    p0 = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    base = float(np.log(p0 / (1 - p0)))
    raw = np.full(n, base)
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int32)
    threshold = np.zeros((trees, nodes))
    value = np.zeros((trees, nodes))
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        work = [(0, np.arange(n), -np.inf, np.inf, 0)]
        while work:
            node, idx, lo, hi, level = work.pop()
            gs, hs = g[idx].sum(), h[idx].sum()
            value[t, node] = rate * np.clip(-gs / (hs + l2), lo, hi)
            best = None
            if level < depth and hs > 2 * min_child * 0.25:
                for f in range(k):
                    if not len(edges[f]):
                        continue
                    b = binned[idx, f]
                    size = len(edges[f]) + 1
                    gl = np.cumsum(np.bincount(b, g[idx], size))[:-1]
                    hl = np.cumsum(np.bincount(b, h[idx], size))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                    gr, hr = gs - gl, hs - hl
                    vl = np.clip(-gl / (hl + l2), lo, hi)
                    vr = np.clip(-gr / (hr + l2), lo, hi)
                    gain = -(gl * vl + 0.5 * (hl + l2) * vl * vl) - (gr * vr + 0.5 * (hr + l2) * vr * vr)
                    ok = (nl >= min_child) & (len(idx) - nl >= min_child)
                    if monotone[f]:
                        ok &= monotone[f] * (vr - vl) >= 0
                    gain = np.where(ok, gain, -np.inf)
                    s = int(gain.argmax())
                    if best is None or gain[s] > best[0]:
                        best = (gain[s], f, s, vl[s], vr[s])
                here = np.clip(-gs / (hs + l2), lo, hi)
                if best is None or best[0] <= -(gs * here + 0.5 * (hs + l2) * here * here) + 1e-6:
                    best = None
            if best is None:
                raw[idx] += value[t, node]
                continue
            _, f, s, vl, vr = best
            feature[t, node], threshold[t, node] = f, edges[f][s]
            left = binned[idx, f] <= s
            mid = (vl + vr) / 2
            l_lo, l_hi, r_lo, r_hi = lo, hi, lo, hi
            if monotone[f] > 0:
                l_hi, r_lo = min(hi, mid), max(lo, mid)
            elif monotone[f] < 0:
                l_lo, r_hi = max(lo, mid), min(hi, mid)
            work.append((2 * node + 1, idx[left], l_lo, l_hi, level + 1))
            work.append((2 * node + 2, idx[~left], r_lo, r_hi, level + 1))
    return Trees(feature, threshold, value, base, depth)


def _level_sums(cells: DataFrame, trees: Trees, done: int, level: int, k: int, width: int) -> np.ndarray:
    """(gradient, curvature, rows) by node of ``level`` of tree ``done``, feature (``k``) and bin, over all cells."""
    first, nodes = 2 ** level - 1, 2 ** level
    before = Trees(trees.feature[:done], trees.threshold[:done], trees.value[:done], trees.base, trees.depth)
    feature, threshold = trees.feature[done], trees.threshold[done]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, nodes * k * width), np.int64)
        for b in batches:
            x = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(-1, k)
            y, n = (b.column(c).to_numpy().astype(np.float64) for c in ("y", "n"))
            at = np.zeros(len(x), np.int64)
            for _ in range(level):
                f = feature[at]
                at = np.where(f < 0, at, 2 * at + 1 + (x[np.arange(len(x)), np.maximum(f, 0)] > threshold[at]))
            live = at >= first  # others rest in a leaf further up
            x, y, n, at = x[live], y[live], n[live], at[live] - first
            p = before.proba(x)
            place = ((at[:, None] * k + np.arange(k)) * width + x).ravel()
            for i, part in enumerate((p - y, np.maximum(p * (1 - p), 1e-9), np.full(len(x), 1 / UNITS))):
                np.add.at(total[i], place, np.repeat((np.rint(part * UNITS) * n).astype(np.int64), k))
        full = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *[pa.array(t[full]) for t in total]], ["at", "g", "h", "n"])

    got = (cells.mapInArrow(sums, "at int, g long, h long, n long").groupBy("at")
                .agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow())
    out = np.zeros((3, nodes * k * width))
    for i, (c, unit) in enumerate((("g", UNITS), ("h", UNITS), ("n", 1.0))):
        out[i, got.column("at").to_numpy()] = got.column(c).to_numpy() / unit
    return out.reshape(3, nodes, k, width)


def fit_cells(cells: DataFrame, edges: list[np.ndarray], share: float, trees: int = 60, depth: int = 3, rate: float = 0.2,
              min_child: float = 2.0, l2: float = 1.0) -> Trees:
    """``fit`` without constraints over rows that stay in Spark, one job a level.
    ``cells``: ``bins`` (a byte a feature: how many of its ``edges``, at most 255, lie
    below), ``y`` and how many rows ``n`` are alike in these; ``share`` of them have y = 1."""
    p0 = min(max(share, 1e-4), 1 - 1e-4)
    nodes, width = 2 ** (depth + 1) - 1, 1 + max(len(e) for e in edges)
    grown = Trees(np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes)), np.zeros((trees, nodes)),
                  float(np.log(p0 / (1 - p0))), depth)  # thresholds are bins until the end
    allowed = np.arange(width - 1) < np.array([len(e) for e in edges])[:, None]
    for t in range(trees):
        for level in range(depth):
            open_ = [i for i in range(2 ** level - 1, 2 ** (level + 1) - 1) if not level or grown.feature[t, (i - 1) // 2] >= 0]
            if not open_:
                break
            sums = _level_sums(cells, grown, t, level, len(edges), width)
            for i in open_:
                g, h, n = sums[:, i - (2 ** level - 1)]
                gs, hs, ns = g[0].sum(), h[0].sum(), n[0].sum()
                if not level:
                    grown.value[t, 0] = -rate * gs / (hs + l2)
                if hs <= 2 * min_child * 0.25:
                    continue
                gl, hl, nl = (np.cumsum(x, axis=1)[:, :-1] for x in (g, h, n))
                gain = 0.5 * (gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2))
                gain = np.where(allowed & (nl >= min_child) & (ns - nl >= min_child), gain, -np.inf)
                f, s = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[f, s] <= 0.5 * gs ** 2 / (hs + l2) + 1e-6:
                    continue
                grown.feature[t, i], grown.threshold[t, i] = f, s
                grown.value[t, 2 * i + 1] = -rate * gl[f, s] / (hl[f, s] + l2)
                grown.value[t, 2 * i + 2] = -rate * (gs - gl[f, s]) / (hs - hl[f, s] + l2)
    threshold = np.array([[edges[f][int(s)] if f >= 0 else 0.0 for f, s in zip(*rows)] for rows in zip(grown.feature, grown.threshold)])
    return Trees(grown.feature, threshold, grown.value, grown.base, depth)
