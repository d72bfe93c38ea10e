"""Personal data: base rules, then candidate gradient boosting.

Base spans of the four base kinds are always kept.  High-recall generators
propose further, overlapping spans (failed base matches, digit groups, values
behind ``name=`` or ``name:``, long mixed tokens); boosted trees score each
from its format and context, and a threshold per kind, calibrated on
candidates the trees have not seen, selects those that are added under the
kinds ``secret`` and ``number``.  The trees learn from weak labels on all
distinct candidates of the corpus, in sums that Spark makes over them.  Positive
are validated base matches, numbers behind a naming word or in a national format,
values behind a credential name and well-known key formats; everything else a
generator proposes is negative.
Base spans teach the trees but calibrate no threshold, as they are never
added, and a candidate that overlaps one is left out.

Offsets are code points of the whole text, end exclusive.

Edge cases: null and empty texts have no spans; null ids get a row; repeated
rows get a row each; an empty table gives no rows; other columns are ignored.
Without candidates of both labels nothing is added to the base spans.
Values with a digit behind a credential name and well-known key formats are
added whatever their score.  Candidates are read whole, and spans meet through
sorted lists, so the time grows in proportion to the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.llm import gbt
from meterlens.llm.util import slices, str_texts, written

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "number")
KINDS = BASE_KINDS + ADDED_KINDS

#: Bins of a feature, cut at quantiles of this rank accuracy (1 / RANKS).
BINS, RANKS = 32, 10_000
#: Steps a unit of the raw score, and where they end, on which thresholds are sought.
GRID, GRID_END = 256, 16
#: Precision on unseen candidates that a kind's threshold must reach.
PRECISION = 0.98

Span = tuple[str, int, int]

_ANY = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the run's first digit decides: a later start in the same run meets the same end
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octets_ok(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part reaches back to
    the previous match or the first other character."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", end if m else at + 1)
    return out


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """All base matches in listed order, with whether they pass their check."""
    if not _ANY.search(text):
        return []
    out = [("email", a, b, True) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end(), _octets_ok(m.group())) for m in _IP.finditer(text)]
        for m in _CARD.finditer(text):
            d = _digits(m.group())
            out.append(("card", m.start(), m.end(), 13 <= len(d) <= 19 and luhn(d)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                out.append(("phone", m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15))
    return out


# ---- candidates -----------------------------------------------------------------
_VALUE = re.compile(r"[A-Za-z_]{2,24}[ ]?[=:][ ]?[\"']?([A-Za-z0-9+/_.-]{6,})")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{14,}+")
_GROUP = re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{3,4}(?![0-9])")
_KEYWORD = re.compile(r"pass|pwd|secret|token|key|tel|phone|fax|call|mail|card|visa|ssn|iban|account|login|user", re.I)
# key formats that are positive on sight, for the weak labels only
_KNOWN = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}")
_CREDENTIAL = re.compile(r"(?:pass(?:word|wd)?|pwd|secret|token|api_?key)[ ]?[=:][ ]?[\"']?$", re.I)

# evidence for numbers outside the base rules, for the weak labels only
_NAMED = re.compile(r"(?<![A-Za-z])(?:tel|telephone|phone|fax|mobile|cell|call|ssn|iban|acct|account|passport)"
                    r"(?:[ ](?:no|nr|number))?[ .:#=]{1,3}$", re.I)
_NATIONAL = re.compile(r"\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}|0[1-9][0-9]{1,2}[ .-][0-9]{3,4}[ .-][0-9]{3,4}|"
                       r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}")

FEATURES = ("length", "digits", "digit_share", "upper_share", "lower_share", "hex_share", "separators", "luhn_card",
            "phone_size", "plus", "at_sign", "octets", "entropy", "assigned", "keyword", "glued_left", "glued_right",
            "class_changes")


def _number(text: str, a: int, b: int) -> int:
    """Weak label of a number that no base rule validates."""
    size = len(_digits(text[a:b]))
    return int(7 <= size <= 19 and bool(_NATIONAL.fullmatch(text, a, b) or _NAMED.search(text[max(0, a - 20):a])))


def candidates(text: str, matches: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, weak label) of every proposed span; spans overlap."""
    good = {(a, b) for _, a, b, ok in matches if ok}
    out = {(a, b): (kind if kind == "email" else "number", 1 if (a, b) in good else _number(text, a, b))
           for kind, a, b, _ in matches}
    spans = [m.span(1) for m in _VALUE.finditer(text)] if "=" in text or ":" in text else []
    if _DIGIT.search(text):
        for m in _GROUP.finditer(text):
            out.setdefault(m.span(), ("number", _number(text, *m.span())))
        spans += [m.span() for m in _TOKEN.finditer(text)]
    for a, b in spans:
        value, named = text[a:b], bool(_CREDENTIAL.search(text[max(0, a - 14):a]))
        if (named or _DIGIT.search(value)) and (a, b) not in out:  # words are values behind a credential name only
            out[(a, b)] = ("secret", int(named or bool(_KNOWN.fullmatch(value))))
    return [(kind, a, b, y) for (a, b), (kind, y) in sorted(out.items())]


def candidate_features(text: str, a: int, b: int) -> list[float]:
    value = text[a:b]
    n = len(value)
    digits = _digits(value)
    upper = sum("A" <= c <= "Z" for c in value)
    lower = sum("a" <= c <= "z" for c in value)
    hexa = sum(c in "0123456789abcdefABCDEF" for c in value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    before = text[max(0, a - 20):a]
    left, right = text[a - 1:a], text[b:b + 1]
    return [float(b - a), len(digits), len(digits) / n, upper / n, lower / n, hexa / n, kinds.count("s"),
            float(13 <= len(digits) <= 19 and luhn(digits)), float(9 <= len(digits) <= 15), float(value[0] == "+"),
            float("@" in value), float(value.count(".") == 3 and all(x.isascii() and x.isdigit() for x in value.split("."))
                                       and _octets_ok(value)),
            entropy, float(bool(re.search(r"[=:][ ]?[\"']?$", before))), float(bool(_KEYWORD.search(before))),
            float(left.isalnum()), float(right.isalnum()),
            sum(x != y for x, y in zip(kinds, kinds[1:])) / n]


@dataclass(frozen=True)
class PiiModel:
    trees: gbt.Trees | None
    thresholds: dict[str, float]

    def added(self, text: str, matches: list[tuple[str, int, int, bool]]) -> list[Span]:
        """Selected candidates that overlap no base span and no better candidate."""
        if self.trees is None:
            return []
        free = _outside([(a, b) for _, a, b, ok in matches if ok])
        cand = [(k, a, b, k == "secret" and y == 1 and bool(_DIGIT.search(text, a, b)))
                for k, a, b, y in candidates(text, matches) if free(a, b)]
        cand = [c for c in cand if c[3] or c[0] in self.thresholds]
        if not cand:
            return []
        p = self.trees.proba(np.array([candidate_features(text, a, b) for _, a, b, _ in cand]))
        chosen: list[tuple[int, int, str]] = []
        for score, (kind, a, b, sure) in sorted(zip(p, cand), key=lambda x: (not x[1][3], -x[0], x[1])):
            if sure or score >= self.thresholds[kind]:
                at = bisect_left(chosen, (b,))  # those before start left of b, and do not overlap each other
                if not at or chosen[at - 1][1] <= a:
                    insort(chosen, (a, b, kind))
        return [(kind, a, b) for a, b, kind in chosen]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), by kind as listed and then start."""
        matches = base_matches(text)
        base = [(k, a, b) for k, a, b, ok in matches if ok]
        return base, base + sorted(self.added(text, matches), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))

    def redact(self, text: str) -> str:
        """Every span replaced by its kind; overlapping spans become one."""
        spans = sorted((a, b, k) for k, a, b in self.spans(text)[1])
        out, at, i = [], 0, 0
        while i < len(spans):
            a, b, kind = spans[i]
            i += 1
            while i < len(spans) and spans[i][0] < b:
                b = max(b, spans[i][1])
                i += 1
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        return "".join(out) + text[at:] if out else text


def _outside(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span overlaps none of ``spans``, which may overlap one another."""
    spans = sorted(spans)
    starts, reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or reach[before - 1] <= a

    return free


def _fitting(text: str, matches: list[tuple[str, int, int, bool]]) -> Iterator[tuple[str, int, int, int, int]]:
    """Candidates with whether each is a base span; those that only overlap one
    can never be added and are left out."""
    good = {(a, b) for _, a, b, ok in matches if ok}
    free = _outside(list(good))
    for kind, a, b, y in candidates(text, matches):
        if (a, b) in good:
            yield kind, a, b, y, 1
        elif free(a, b):
            yield kind, a, b, y, 0


def _proposed(docs: DataFrame) -> DataFrame:
    """``hash, kind, y, base`` and FEATURES of every distinct candidate of all documents."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = set()
            for text in str_texts(b.column("text")):
                for kind, s, e, y, base in _fitting(text, base_matches(text)):
                    key = hashlib.blake2b(text[max(0, s - 20):e].encode("utf-8", "replace"), digest_size=8)
                    found.add((int.from_bytes(key.digest(), "little", signed=True), kind, y, base,
                               tuple(candidate_features(text, s, e))))
            rows = sorted(found)
            x = [r[4] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32()),
                 *[pa.array([f[i] for f in x], pa.float64()) for i in range(len(FEATURES))]],
                ["hash", "kind", "y", "base", *FEATURES])

    return docs.select("text").mapInArrow(
        propose, "hash long, kind string, y int, base int, " + ", ".join(f"{f} double" for f in FEATURES)).distinct()


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([b.column(f).to_numpy() for f in FEATURES])


def _cells(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """``bins, y, n``: how many candidates agree in all their bins and the label."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.column_stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, _matrix(b).T)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in at], pa.binary()), b.column("y")], ["bins", "y"])

    return rows.select("y", *FEATURES).mapInArrow(bins, "bins binary, y int").groupBy("bins", "y").agg(F.count(F.lit(1)).alias("n"))


def _thresholds(unseen: DataFrame, trees: gbt.Trees) -> dict[str, float]:
    """By kind the lowest score (at least 0.5) from which on PRECISION of all
    ``unseen`` candidates are labelled positive, on a grid of raw scores."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.floor(np.clip(trees.raw(_matrix(b)), -GRID_END, GRID_END) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("y"), pa.array(at)], ["kind", "y", "at"])

    got = (unseen.select("kind", "y", *FEATURES).mapInArrow(score, "kind string, y int, at int")
                 .groupBy("kind", "at").agg(F.sum("y").alias("hits"), F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for kind in ADDED_KINDS:
        rows = sorted(((r["at"], r.hits, r.n) for r in got if r.kind == kind), reverse=True)
        at, hits, n = np.array(rows, np.int64).reshape(-1, 3).T
        hits = np.cumsum(hits)
        precise = np.flatnonzero(hits / np.cumsum(n) >= PRECISION)
        if len(precise) and hits[precise[-1]] > 0:
            out[kind] = max(0.5, float(1 / (1 + np.exp(-at[precise[-1]] / GRID))))
    return out


def fit_pii(docs: DataFrame, limit: int | None = None) -> PiiModel:
    """Fit on the distinct candidates of all documents, or only on the ``limit``
    of smallest hash.  They stay in Spark; the driver sees sums of bounded size."""
    rows = _proposed(docs)
    if limit is not None:
        rows = rows.orderBy("hash", "kind", "y", "base", *FEATURES).limit(limit)
    rows = written(rows.withColumn("unseen", F.col("hash").bitwiseAND(F.lit(3)) == 3), "pii-candidates")
    count = {(r.unseen, r.y): r["count"] for r in rows.groupBy("unseen", "y").count().collect()}
    seen, positive = count.get((False, 0), 0) + count.get((False, 1), 0), count.get((False, 1), 0)
    if sum(count.values()) < 40 or sum(count.values()) == seen or positive in (0, seen):
        return PiiModel(None, {})
    part = [i / BINS for i in range(1, BINS)]
    seen_rows = rows.filter("not unseen")
    at = seen_rows.agg(*[F.percentile_approx(f, part, RANKS).alias(f) for f in FEATURES]).first()
    edges = [np.unique(at[f]) for f in FEATURES]
    trees = gbt.fit_cells(written(_cells(seen_rows, edges), "pii-cells"), edges, positive / seen, trees=40)
    return PiiModel(trees, _thresholds(rows.filter("unseen and base = 0"), trees))


def _line(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """Per document: spans of both sorts as ``kind:start:end`` lists and counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            both = [model.spans(t) for t in str_texts(b.column("text"))]
            counts = [[sum(k == name for k, _, _ in base) for base, _ in both] for name in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([_line(x) for x, _ in both], pa.string()), pa.array([_line(x) for _, x in both], pa.string())],
                ["doc_id", *[f"n_{n}" for n in BASE_KINDS], "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {kind}, " + ", ".join(f"n_{n} long" for n in BASE_KINDS) + ", base string, spans string")


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """All rows and columns, with every span of ``text`` replaced by its kind
    and ``n_chars``, where there is such a column, brought up to date."""
    schema = docs.schema
    counted = "n_chars" in schema.names and isinstance(schema["n_chars"].dataType, (T.LongType, T.IntegerType))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            new = [t if t is None else model.redact(t) for t in texts]
            at = b.schema.get_field_index("text")
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if counted:
                n = b.schema.get_field_index("n_chars")
                cols[n] = pa.array([old if x is y else len(y) for x, y, old in zip(texts, new, cols[n].to_pylist())],
                                   b.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(change, schema)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii`` rows."""
    return found.select("doc_id", *[f"n_{n}" for n in BASE_KINDS],
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
