"""The conversation trie against a plain one, with small chunks and bands."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from meterlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, ka string, n_convs string, up string"


def conversations():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 60), *range(-12, 0), 101, 103, 2 ** 62 + 1]:
        for t in range(rng.choice([0, 1, 2, 3, 6, 12])):
            rows.append((c, rng.choice([t, t, t, 2]), rng.choice(["user", "user", "system", None]), rng.choice(["a", "b", "", None, "é" * 9])))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(11)]  # one long common conversation
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(150)] + [(301, t, "user", f"turn {t % 3}") for t in range(170)]
    rows += [(7, None, "user", "x"), (7, None, None, None), (7, None, "user", "x"), (None, 1, "user", "x"), (None, None, None, None),
             (400, 0, "user", "w " * 50_000)]
    return rows


def brute(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0, tie), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (c % 5 if c >= 0 else -(-c % 5))
        seq = tuple(own.get(source, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = collections.Counter(s[:-1] for s in members if s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += children[s] == 0
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1].encode()) if s else 0
    return [(m[0], len(s), members[s[:-1]][0] if s else None, len(m), children[s], leaves[s], saved[s],
             hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest()) for s, m in members.items()]


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def want(rows):
    return sorted(brute(rows), key=str)


@pytest.mark.parametrize("chunk, band, piece", [(trie.CHUNK, trie.BAND, trie.PIECE), (16, 4, 7)])
def test_equals_plain_trie(spark, rows, want, chunk, band, piece):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in trie.build_trie(df, chunk, band, piece).select(*trie.CONTRACT).collect()]
    assert sorted(got, key=str) == want


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.build_trie(empty).count() == 0
    one = [(1, 0, "user", "x")]  # its only turn is taken from a source that is not there
    got = trie.build_trie(spark.createDataFrame([(*r, "", "", "") for r in one], SCHEMA)).select(*trie.CONTRACT).collect()
    assert [tuple(r) for r in got] == brute(one)


def test_ends_cross_tasks(spark):
    """One node where thousands end, and many where few do."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = {(1, 5, 5): list(range(-700, 4000, 3)), (2, 5, 5): [9, 8], (1, 6, 5): [4]}
        ids.update({(3, k, -k): [k, k + 1, 2 ** 62] for k in range(300)})
        rows = [(*k, v) for k, vs in ids.items() for v in vs]
        df = spark.createDataFrame(rows, "depth long, ka long, kb long, conv_id long").repartition(6)
        got = {(r.depth, r.ka, r.kb): r.ends_sha256 for r in trie.end_digests(df, 10).collect()}
        for k, vs in ids.items():
            if len(vs) > 1:
                assert got[k] == hashlib.sha256(",".join(map(str, sorted(vs))).encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
