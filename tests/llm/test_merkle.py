"""The Merkle manifest against a plain tree, and positions across tasks."""

from __future__ import annotations

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from meterlens.llm import merkle
from meterlens.llm.ranks import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, rank string"
ROWS = ([(i, f"text {i} é", "en", "s0", i) for i in range(137)]
        + [(i, "x" * (i % 5), "de", None, None) for i in range(200, 233)]
        + [(1000, "lone", "fr", "s", 4), (None, "no id", "en", "s0", 5), (None, None, None, None, None),
           (7, "again", "en", "s1", 1), (7, "again", "en", "s1", 1), (300, "", "", "", 0), (301, None, None, "s", 9),
           (302, "é" * 9000, None, "s", 2 ** 63 - 1), (2 ** 62, "big", "de", "s", -1)]
        + [(5000 + i, "t", "zz", "s", 2 ** 63 - 1) for i in range(9)])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H(*low[i:i + 2]) for i in range(0, len(low), 2)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 2
        out.append(([x for i, x in enumerate(level[run:run + 2], run) if i != at], at % 2))
        at //= 2
    return out


def brute(rows):
    langs = collections.defaultdict(list)
    for r in rows:
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(langs[k], key=lambda x: x[:3])]) for k in order}
    top = tree([trees[k][-1][0] for k in order])
    out = []
    for n, k in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(sorted(langs[k], key=lambda x: x[:3])):
            steps = way(trees[k], at) + way(top, n)
            cur = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                cur = leaf_of(*r[:4], r[4] + 1)
            for near, odd in steps:
                cur = H(*near, cur) if odd else H(cur, *near)
            root = top[-1][0]
            out.append((r[0], leaf, trees[k][-1][0], root, H(*[d for near, _ in steps for d in near]), cur, cur == root))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in ROWS], SCHEMA).repartition(5)


@pytest.mark.parametrize("levels", [2, 3, merkle.LEVELS])
def test_equals_plain_tree(docs, levels):
    got = [tuple(r) for r in merkle.proofs(merkle.build_manifest(docs, levels)).collect()]
    assert sorted(got, key=str) == sorted(brute(ROWS), key=str)
    assert any(not r[6] for r in got)


def test_a_version_copies_only_its_ancestors(docs):
    for r in merkle.build_manifest(docs, 3).filter("copies IS NOT NULL").collect():
        assert len(r.copies) == len(r.sides) + 1 and r.copies[0] == r.changed and r.copies[-1] == r.folded
        assert len(r.digests) == 32 * sum(s != "-" for s in r.sides)


def test_small_tables(spark, docs):
    assert merkle.proofs(merkle.build_manifest(docs.limit(0))).count() == 0
    one = ROWS[140:141]
    got = merkle.proofs(merkle.build_manifest(spark.createDataFrame([(*one[0], "a", "b", "c")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == brute(one)
    assert got[0].leaf == got[0].root and got[0].proof_sha256 == H("")


def test_ranks_of_one_tree_over_many_tasks(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for share in (1, 3, 50, 10_000):  # rows a tree
            df = spark.range(0, 4000, 1, 7).select((F.col("id") / share).cast("long").alias("t"), (-F.col("id")).alias("o"))
            got = ranked(df, "t", [F.col("o").asc()], "test-ranks").collect()
            want = collections.defaultdict(list)
            for i in range(4000):
                want[i // share].append(-i)
            assert sorted((r.t, r.o, r["rank"]) for r in got) == sorted(
                (t, o, k) for t, os in want.items() for k, o in enumerate(sorted(os)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
