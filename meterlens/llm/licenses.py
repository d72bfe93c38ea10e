"""Licence scans: ordered signature rules, DataFrame operations only.

A text becomes words (ASCII lower case; runs of digits, letters and anything
beyond ASCII).  One pass finds which of the rules' keywords it holds; texts
with none are done.  Only rules whose keyword is there are matched, each
leftmost without overlap at words' borders, and every match becomes an
interval of words.  A detection goes when a detection of the same or a
stronger rank contains its interval; on equal intervals and ranks the
earlier rule stays.  One sweep over the sorted intervals decides this, with
the furthest end so far of each rank as its only state, so that the work
grows with a text's matches, not with their pairs.

Base phrases are rules too: all of their places count, and their labels stay
whether or not a longer detection suppresses them.  ``score`` is the largest
strength of the detections left (0 without any).

Nothing is shuffled: a row depends on its own text alone.

Edge cases: null and empty texts have no words, no labels and score 0;
repeated rows and null ids get a row each; an empty table gives no rows;
other columns are ignored, whatever their names; very long texts are scanned
whole.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.license_rules import Rule, rules
from meterlens.plans.barrier import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, before and after A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKS = 5
#: A match, its fields in the order of the sweep.
HITS = "array<struct<start:long,minus_end:long,rank:int,number:int,label:string,strength:double,base:boolean>>"
#: Values of a running sum that one array grows by.
PIECE = 512


def _spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _table(found: list[Rule]) -> Column:
    """The rules as one constant."""
    rows = json.dumps([{**r._asdict(), "pattern": f"(?<= ){r.pattern}(?= )"} for r in found])
    return F.from_json(F.lit(rows), "array<struct<number:int,rank:int,label:string,keyword:string,pattern:string,"
                                    "strength:double,base:boolean>>")


def _any_of(keywords: list[str]) -> str:
    """A pattern of a space and one of the keywords, which share their first letters."""
    by_first: dict[str, list[str]] = {}
    for k in keywords:
        by_first.setdefault(k[0], []).append(k[1:])
    return " (?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")(?= )"


def _running(values: Column) -> Column:
    """Exclusive running sums.  An array that grows is copied at every step,
    so it grows within pieces of ``PIECE`` values, whose totals run likewise."""
    def grow(xs: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(xs, empty, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    firsts = F.sequence(F.lit(1), F.size(values), F.lit(PIECE))
    pieces = F.transform(firsts, lambda i: grow(F.slice(values, i, F.lit(PIECE))))
    before = grow(F.transform(pieces, lambda p: p["at"]))["out"]
    return F.flatten(F.zip_with(pieces, before, lambda p, b: F.transform(p["out"], lambda x: x + b)))


def _intervals(text: Column, rule: Column, matches: Column) -> Column:
    """A struct per match, its fields in the order of the sweep.  The words
    between matches and in them give each one's place."""
    between = F.transform(F.split(text, rule["pattern"], -1), lambda s: _spaces(s) - 1)
    sizes = F.transform(matches, lambda m: _spaces(m) + 1)
    steps = F.zip_with(between, sizes, lambda b, m: F.struct(b.alias("between"), m.alias("size")))
    steps = F.slice(steps, F.lit(1), F.size(matches))  # the text behind the last match is left out
    starts = _running(F.transform(steps, lambda x: x["between"] + x["size"]))
    return F.zip_with(steps, starts, lambda x, before: F.struct(
        (before + x["between"]).alias("start"), (-(before + x["between"] + x["size"])).alias("minus_end"),
        rule["rank"].alias("rank"), rule["number"].alias("number"), rule["label"].alias("label"),
        rule["strength"].alias("strength"), rule["base"].alias("base")))


def _sweep(hits: Column) -> Column:
    """``labels`` and ``score`` of the hits that no other suppresses."""
    start = F.struct(F.array_repeat(F.lit(-1).cast("long"), RANKS).alias("ends"),
                     F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(acc: Column, h: Column) -> Column:
        end = -h["minus_end"]
        covered = F.array_max(F.slice(acc["ends"], F.lit(1), h["rank"] + 1)) >= end
        ends = F.transform(acc["ends"], lambda e, i: F.when(i == h["rank"], F.greatest(e, end)).otherwise(e))
        labels = F.when(covered, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(h["label"])))
        score = F.when(covered, acc["score"]).otherwise(F.greatest(acc["score"], h["strength"]))
        return F.struct(ends.alias("ends"), labels.alias("labels"), score.alias("score"))

    return F.aggregate(hits, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["score"].alias("score")))


def scan_licenses(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """``doc_id, n_words, hits, labels, score`` per row of ``docs`` (``doc_id, text``).

    ``hits`` are all matches before suppression: ``start, end`` (words, end
    exclusive), ``label``, ``number`` of the rule, ``base``, in order of
    their place.  ``labels`` are those of the detections left, unsorted.
    """
    found = rules() if found is None else found
    keywords = sorted({r.keyword for r in found})
    wanted = _any_of(keywords)
    table = _table(found)
    trimmed = F.trim(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), GAP, " "))
    # what several expressions or lambdas use is computed once per row, not inlined into each of them
    words = materialize(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")), ["doc_id"],
                        {"words": F.concat(F.lit(" "), trimmed, F.lit(" "))})
    # a keyword makes a text worth lower-casing; all others are done here
    gated = materialize(words, ["doc_id"], {
        "n_words": F.when(F.col("words") == "  ", F.lit(0)).otherwise(_spaces(F.col("words")) - 1).cast("long"),
        "words": F.when(F.col("words").rlike("(?i)" + wanted), F.translate("words", _UPPER, _LOWER))})
    held = F.transform(F.array_distinct(F.regexp_extract_all("words", F.lit(wanted), F.lit(0))), lambda k: F.substring(k, 2, 64))
    keyed = materialize(gated, ["doc_id", "n_words", "words"], {"held": F.coalesce(held, F.array().cast("array<string>"))})
    tried = F.transform(F.filter(table, lambda r: F.array_contains(F.col("held"), r["keyword"])), lambda r: F.struct(
        r.alias("rule"), F.regexp_extract_all(F.col("words"), r["pattern"], F.lit(0)).alias("matches")))
    matched = materialize(keyed, ["doc_id", "n_words", "words"], {
        "tried": F.when(F.size("held") > 0, F.filter(tried, lambda t: F.size(t["matches"]) > 0))})
    hits = F.sort_array(F.flatten(F.transform("tried", lambda t: _intervals(F.col("words"), t["rule"], t["matches"]))))
    placed = materialize(matched, ["doc_id", "n_words"], {"raw": F.coalesce(hits, F.array().cast(HITS))})
    swept = materialize(placed, ["doc_id", "n_words", "raw"], {"left": _sweep(F.col("raw"))})
    shown = F.transform("raw", lambda h: F.struct(h["start"].alias("start"), (-h["minus_end"]).alias("end"), h["label"].alias("label"),
                                                  h["number"].alias("number"), h["base"].alias("base")))
    return swept.select("doc_id", "n_words", shown.alias("hits"), F.col("left.labels").alias("labels"),
                        F.col("left.score").alias("score"))


def report(scan: DataFrame) -> DataFrame:
    """The contract's columns."""
    base = F.filter("hits", lambda h: h["base"])
    start = F.transform("base", lambda h: h["start"])
    names = F.array_distinct(F.transform("base", lambda h: h["label"]))
    return (materialize(scan, ["doc_id", "n_words", "hits", "labels", "score"], {"base": base})
                .select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
                        F.array_join(F.sort_array(names), ",").alias("base_labels"),
                        F.array_join(F.sort_array(F.array_union(names, "labels")), ",").alias("labels"), "score"))


def _oracle() -> str:
    """The same scan in DuckDB SQL: each rule against each text with its
    keyword, spaces doubled so that a match may take one on either side;
    suppression by comparing all pairs of a document's detections."""
    rows = ",\n    ".join(f"({r.number}, {r.rank}, '{r.label}', '{r.keyword}', ' {r.pattern.replace(' ', '~')} ', "
                          f"{r.strength}, {str(r.base).lower()})" for r in rules())
    return f"""
WITH r(number, rank, label, keyword, pattern, strength, base) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS n, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')) AS words FROM documents),
w AS (SELECT n, doc_id, CASE WHEN words = '' THEN 0 ELSE length(words) - length(replace(words, ' ', '')) + 1 END AS n_words,
    ' ' || words || ' ' AS one FROM d),
t AS (SELECT w.n, replace(one, ' ', '  ') AS two, r.*, replace(pattern, '~', '  ') AS regex
    FROM w JOIN r ON contains(one, ' ' || keyword || ' ')),
m AS (SELECT *, regexp_extract_all(two, regex) AS got, string_split_regex(two, regex) AS seg FROM t),
p AS (SELECT *, unnest(range(len(got))) AS i FROM m WHERE len(got) > 0),
-- a match of k words holds 2k spaces less none: k = spaces // 2; all spaces before it are 2 a word, and 1 of its own gap
h AS (SELECT n, number, rank, label, strength, base,
    (length(pre) - length(replace(pre, ' ', ''))) // 2 AS s, (length(got[i + 1]) - length(replace(got[i + 1], ' ', ''))) // 2 AS k
    FROM (SELECT *, array_to_string(list_concat(seg[1:i + 1], got[1:i]), '') AS pre FROM p)),
left_over AS (SELECT * FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.n = a.n AND b.s <= a.s AND b.s + b.k >= a.s + a.k
    AND b.rank <= a.rank AND (b.s, -b.s - b.k, b.rank, b.number) < (a.s, -a.s - a.k, a.rank, a.number))),
b AS (SELECT n, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word FROM h WHERE base GROUP BY n),
bl AS (SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h WHERE base GROUP BY n),
al AS (SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
    (SELECT n, label FROM left_over UNION SELECT n, label FROM h WHERE base) GROUP BY n),
sc AS (SELECT n, max(strength) AS score FROM left_over GROUP BY n)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN b USING (n) LEFT JOIN bl USING (n) LEFT JOIN al USING (n) LEFT JOIN sc USING (n)
"""


ORACLE = _oracle()
