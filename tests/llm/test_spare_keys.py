"""Block keys that sets give up lose no link, and passages that many texts share open no keys."""

from __future__ import annotations

import random

import numpy as np
import pytest

from meterlens.llm import jaccard
from tests.llm.test_operators import brute_components


@pytest.mark.parametrize("num,den", [(4, 5), (85, 100), (1, 2)])
def test_linked_sets_keep_a_common_key(num, den):
    rng = np.random.default_rng(num)
    sets = []
    for n in (12, 40, 90, 300, 1000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.int64).astype(np.uint64))
            most = (den - num) * 2 * len(a) // (den + num)  # shingles in which a set may differ
            out, new = int(rng.integers(0, most // 2 + 1)), most // 2
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[out:]],
                                          rng.integers(0, 2 ** 63, new - out, dtype=np.int64).astype(np.uint64)]))
            sets += [a, b]
    starts = np.cumsum([0] + [len(x) for x in sets])
    owner, key = jaccard.block_keys(starts, np.concatenate(sets), num, den)
    spare = jaccard.spare_keys(starts, owner, key, num, den)
    assert spare.sum()
    order = rng.permutation(len(np.unique(key)))  # any one order of all keys will do
    place = order[np.searchsorted(np.unique(key), key)]
    kept = []
    for i in range(len(sets)):
        mine = []
        for bit in (0, 1):
            at = np.flatnonzero((owner == i) & ((key & jaccard.ONE) == bit))
            at = at[np.argsort(place[at])]
            mine.append(key[at[:len(at) - spare[i, bit]]])
        kept.append(set(np.concatenate(mine).tolist()))
    linked = 0
    for i in range(0, len(sets), 2):
        a, b = sets[i], sets[i + 1]
        both = np.intersect1d(a, b).size
        if den * both >= num * (len(a) + len(b) - both):
            linked += 1
            assert kept[i] & kept[i + 1]
    assert linked > 50


def test_a_third_of_the_texts_share_a_long_passage(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(4000)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(150):
        own = [rnd.choice(vocab) for _ in range(rnd.choice([20, 40, 70]))]
        rows.append((i, " ".join(passage + own if i % 3 == 0 else own)))
        if i % 10 == 0:  # a near copy
            own[rnd.randrange(len(own))] = "other"
            rows.append((1000 + i, " ".join(passage + own if i % 3 == 0 else own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(df, 5, 4, 5).collect()}
    assert got == brute_components(rows, 5, 4, 5)
