"""The trees and thresholds of operator 2 come from all distinct candidates."""

from __future__ import annotations

import numpy as np

from meterlens.llm import gbt, pii


def test_trees_from_cells_equal_those_from_rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 12, 900), rng.integers(0, 5, 900), np.zeros(900, int)]).astype(float)
    y = ((x[:, 0] > 6) ^ (x[:, 1] == 2) ^ (rng.random(900) < 0.1)).astype(float)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]).astype(np.uint8)
    cells: dict[tuple[bytes, int], int] = {}
    for b, label in zip(bins, y):
        cells[b.tobytes(), int(label)] = cells.get((b.tobytes(), int(label)), 0) + 1
    df = spark.createDataFrame([(bytearray(b), label, n) for (b, label), n in cells.items()], "bins binary, y int, n long").repartition(3)
    got, want = gbt.fit_cells(df, edges, float(y.mean()), trees=4), gbt.fit(x, y, trees=4)
    assert (got.feature >= 0).any() and np.array_equal(got.feature, want.feature) and np.array_equal(got.threshold, want.threshold)
    assert np.allclose(got.raw(x), want.raw(x), atol=1e-6)


def test_every_distinct_candidate_is_fitted_on(spark, monkeypatch):
    n, seen = 12_000, []  # two candidates a text, more than a driver's sample once held
    letters = str.maketrans("0123456789", "ghijklmnop")  # no long runs of digits, which a base rule could take
    texts = [f"phone {200 + i % 700}-{200 + i % 800}-{1000 + i % 9000} or item/7{f'{i:016x}'.translate(letters)}" for i in range(n)]
    wanted = {t[max(0, a - 20):b] for t in texts for _, a, b, _, _ in pii._fitting(t, pii.base_matches(t))}
    assert len(wanted) > 20_000

    def fit(cells, edges, share, trees, real=gbt.fit_cells):
        seen.append(cells.groupBy().sum("n").first()[0])
        return real(cells, edges, share, trees=2)

    def thresholds(unseen, trees, real=pii._thresholds):
        seen.append(unseen.count())
        return real(unseen, trees)

    monkeypatch.setattr(gbt, "fit_cells", fit)
    monkeypatch.setattr(pii, "_thresholds", thresholds)
    # copies of texts count once
    model = pii.fit_pii(spark.createDataFrame([(t,) for t in texts + texts[:500]], "text string").repartition(5))
    assert model.trees is not None and len(seen) == 2 and sum(seen) == len(wanted)
