"""Licence scans against a brute force over words, and on awkward texts."""

from __future__ import annotations

import re

import pytest

from meterlens.llm import licenses
from meterlens.llm.license_rules import BASE, rules

SCHEMA = "doc_id long, text string, words string, hits string, score string"
LONG = " ".join(["released under the MIT license;", "GNU General Public License, version 3", "plain words"] * 1500)
TEXTS = [
    (1, "Released under the MIT License."), (2, "MIT"), (3, None), (4, ""), (5, " \t\n"), (None, "cc by"),
    (7, "the GNU General Public License, version 3.0; and the GNU General Public License"),
    (8, "GNU Lesser General Public License v2.1 or later"), (9, "SPDX-License-Identifier: Apache-2.0"),
    (10, "cc-by cc by CC.BY cc by-nc-sa 4.0"), (11, "mit license mit license mit license"), (11, "mit license mit license mit license"),
    (12, "Permission is hereby granted, free of charge, to any person obtaining a copy of this, under the Apache License, Version 2.0"),
    (13, "éapache license apache licenseé apache_license  apache license"), (14, LONG), (15, "a" * 40_000),
    (16, "APACHE LICENSE"), (17, "\x00mit\x7flicense\x00"), (18, "cc by 4.0 all rights reserved"),
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    joined = " " + " ".join(words) + " "
    places, hits = [], []
    for phrase, label in BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    for r in rules():
        for m in re.finditer(f"(?<= ){r.pattern}(?= )", joined):
            s = joined.count(" ", 0, m.start()) - 1
            hits.append((s, s + len(m[0].split(" ")), r))
    left = [(s, e, r) for s, e, r in hits if not any(
        a <= s and b >= e and q.rank <= r.rank and (a, -b, q.rank, q.number) < (s, -e, r.rank, r.number) for a, b, q in hits)]
    base = {label for _, label in places}
    starts = [s for s, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {r.label for _, _, r in left})), max((r.strength for _, _, r in left), default=0.0))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in TEXTS], SCHEMA).repartition(3)


def test_equals_brute_force(docs):
    got = sorted((tuple(r) for r in licenses.report(licenses.scan_licenses(docs)).collect()), key=str)
    short = {t: brute(t) for _, t in TEXTS if t != LONG}
    want = sorted(((i, *short[t]) for i, t in TEXTS if t != LONG), key=str)
    assert [r for r in got if r[0] != 14] == want
    n = LONG.lower().count("mit license")
    long = next(r for r in got if r[0] == 14)
    assert long[2] == 2 * n and long[3] == 3 and long[6] == "gpl,gpl-3.0,mit"


def test_longer_and_stronger_detections_suppress(docs):
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert rows[9].labels == ["apache-2.0"] and rows[9].score == 1.0
    assert sorted(rows[7].labels) == ["gpl", "gpl-3.0"]  # the second place stands alone
    assert sorted(set(rows[12].labels)) == ["apache-2.0", "mit"]


def test_rules_are_well_formed():
    found = rules()
    assert len(found) > 300 and len({r.pattern for r in found}) == len(found)
    assert [r.number for r in found] == list(range(len(found)))
    assert all(0 <= r.rank < licenses.RANKS for r in found)
    for r in found:  # a keyword is a word of the pattern that no alternative leaves out
        plain = re.sub(r"\(\?:[^()]*\)\??|\w\?", "#", r.pattern)
        assert r.keyword in re.split(r"[^a-z0-9]+", r.pattern), r
        assert r.keyword in re.split(r"[^a-z0-9]+", plain) or r.pattern.count("|"), r


def test_running_sums_cross_pieces(spark):
    from pyspark.sql import functions as F
    n = 2 * licenses.PIECE + 3
    df = spark.range(1).select(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long")).alias("v"))
    got = df.select(licenses._running(F.col("v"))).first()[0]
    assert got == [i * (i + 1) // 2 for i in range(n)]


def test_empty_table_and_no_python(spark, docs):
    empty = licenses.report(licenses.scan_licenses(docs.limit(0)))
    assert empty.count() == 0
    plan = licenses.report(licenses.scan_licenses(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
