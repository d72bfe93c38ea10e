"""One component per id, wherever its rows lie."""

from __future__ import annotations

import pytest

from meterlens.llm import jaccard

A = "one two three four five six seven eight nine ten"
B = "red orange yellow green blue indigo violet black white grey"
C = "up down left right north south east west above below"


@pytest.mark.parametrize("slices", [1, 2, 5])
def test_repeated_ids_have_one_component(spark, slices):
    rows = [(1, A), (2, A), (2, B), (3, B), (11, A), (12, C), (15, C), (15, A), (20, ""), (20, C), (30, "x y z w v u")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(slices) if slices > 1 else \
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {}
    for r in jaccard.similar_documents(df, k=4, num=85, den=100).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert got == {1: {1}, 2: {1}, 3: {1}, 11: {1}, 12: {1}, 15: {1}, 20: {1}, 30: {30}}
    assert sorted(r.doc_id for r in jaccard.keep_one(df, k=4, num=85, den=100).collect()) == [1, 30]
