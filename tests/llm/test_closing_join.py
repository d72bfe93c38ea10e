"""Edited copies that share many keys but don't link meet once around their
centre, and only pairs whose whole sketches could link leave the closing join."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from meterlens.llm import jaccard
from tests.llm.test_operators import brute_components


def edited_copies() -> list[tuple[int, str]]:
    """Long texts around one original, most of them too far from each other to link."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(5000)]
    original = [rnd.choice(vocab) for _ in range(900)]
    rows = [(0, " ".join(original))]
    for i in range(1, 40):
        words = list(original)
        for at in rnd.sample(range(len(words)), 22):
            words[at] = rnd.choice(vocab)
        rows.append((i, " ".join(words)))
        if i % 13 == 0:  # links with its copy alone
            words[450] = "other"
            rows.append((100 + i, " ".join(words)))
    return rows


def test_edited_copies_meet_once(spark, monkeypatch):
    rows, steps, keep = edited_copies(), {}, jaccard.written

    def written(df, name):
        steps[name] = keep(df, name)
        return steps[name]

    monkeypatch.setattr(jaccard, "written", written)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(df, 4, 85, 100).collect()}
    assert got == brute_components(rows, 4, 85, 100)
    assert 4 * steps["jaccard-rest"].count() <= steps["jaccard-named"].count()  # a row per key before


def test_meets_by_key_where_that_takes_fewer_pairs(spark):
    """Disjoint keys around one centre stay apart; overlapping ones fold."""
    rows = [(10 * c + k, c, 100 * c + (10 * k * (c == 1)) + d, 100 * c + d % 3) for c in (1, 2) for k in range(5) for d in range(6)]
    named = spark.createDataFrame(rows, "key long, centre long, doc long, label long")
    met = {(r.centre, r.group): r.n for r in jaccard._meetings(named).groupBy("centre", "group").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert met == {**{(1, 10 + k): 6 for k in range(5)}, (2, 0): 6}


def test_only_close_sketches_cross(spark):
    """Of three sketches that agree in every fourth word's parity, two are close."""
    a = [0] * jaccard.SKETCH_WORDS
    far = [2 ** 40 - 1] * jaccard.SKETCH_WORDS  # parities of four such words cancel
    near = [1, *a[1:]]
    rows = [(1, 0, i, i, 100, s) for i, s in enumerate((a, near, far))]
    rest = spark.createDataFrame(rows, "centre long, group long, doc long, label long, n long, sketch array<long>")
    assert [tuple(r) for r in jaccard._crossing(rest, 85, 100).collect()] == [(0, 1)]
