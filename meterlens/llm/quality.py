"""Quality rules: base rules, then gradient-boosted trees over document statistics.

``words`` are ``[^\\x20\\x09-\\x0D]+``.  One narrow pass computes the
statistics of each whole text and scores them; nothing is shuffled but the
bounded label sample the trees are fitted on.

Edge cases: null and empty texts have no words (all counts 0, base_failed);
null ids get a row with a null id; repeated rows get a row each; an empty
table gives no rows; other columns are ignored.  With no labelled documents,
or labels of one kind only, the trees accept everything and the base rules
alone decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlens.llm import gbt
from meterlens.llm.util import WHITE, bounded_labels, byte_texts, labelled_texts, slices

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Bound of the labelled sample that the trees are fitted on.
FIT_ROWS = 20_000
#: Share of clean sample documents that the verdict may reject.
CLEAN_LOSS = 0.002

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
PUNCT = b".,;:!?"

#: name -> monotonic direction of the quality score in it
FEATURES = {"log_words": 0, "mean_chars": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "distinct_share": 0, "upper_share": -1, "digit_share": 0, "punct_share": 0, "bang_share": -1,
            "adjacent_share": -1, "top_share": -1, "line_words": 0}


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside a 3-word window that occurs twice or more in the text."""
    n = len(ids)
    if n < 4:
        return 0
    if distinct < 2_000_000:  # three ids fit one 63-bit key
        key = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        _, pair = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)
        key = pair * distinct + ids[2:]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(n, dtype=bool)
    mark[:-2] = twice
    mark[1:-1] |= twice
    mark[2:] |= twice
    return int(mark.sum())


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def document_stats(text: bytes) -> tuple[list[int], list[float]]:
    """([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], features)."""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, _count(text, SYMBOLS), 0, 0], [0.0] * len(FEATURES)
    body = text.translate(None, WHITE)
    chars = len(body) if body.isascii() else len(body.decode("utf-8", "replace"))
    symbols = _count(body, SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    repeated = repeat_words(ids, len(seen))
    upper, lower = _count(body, UPPER), _count(body, LOWER)
    size = len(body)
    return ([n, chars, symbols, dup_lines, repeated],
            [np.log1p(n), chars / n, symbols / size, dup_lines / len(lines), repeated / n,
             len(seen) / n, upper / max(1, upper + lower), _count(body, DIGITS) / size,
             _count(body, PUNCT) / size, _count(body, b"!") / size,
             float((ids[1:] == ids[:-1]).sum()) / n, float(np.bincount(ids).max()) / n,
             np.log1p(n / len(lines))])


def base_failed(n_words, n_repeat):
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class QualityModel:
    trees: gbt.Trees | None
    threshold: float

    def accepts(self, features: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(features):
            return np.ones(len(features), dtype=bool)
        return self.trees.proba(features) >= self.threshold


def fit_quality(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``limit`` labelled documents (smallest id hash); the
    threshold is set on a quarter of them that the trees have not seen."""
    names = list(FEATURES)

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [document_stats(t)[1] for t in byte_texts(b.column("text"))]
            x = np.array(rows, dtype=np.float64).reshape(len(rows), len(names))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y")] + [pa.array(x[:, i]) for i in range(len(names))],
                ["doc_id", "y", *names])

    rows = labelled_texts(docs, bounded_labels(labels, "quality", limit))
    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(stats, f"doc_id {kind}, y int, " + ", ".join(f"{c} double" for c in names)).toArrow()
    got = got.sort_by("doc_id")  # the fit does not depend on the order of arrival
    y = got.column("y").to_numpy().astype(np.float64)
    x = np.column_stack([got.column(c).to_numpy() for c in names]) if len(y) else np.zeros((0, len(names)))
    if len(y) < 40 or y.min() == y.max():
        return QualityModel(None, 0.0)
    test = np.arange(len(y)) % 4 == 3
    trees = gbt.fit(x[~test], y[~test], monotone=list(FEATURES.values()))
    held = np.sort(trees.proba(x[test][y[test] == 1]))
    cut = float(held[int(len(held) * CLEAN_LOSS)]) if len(held) else 0.0
    return QualityModel(trees, min(0.5, cut))


def judge_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``score``, ``kept``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [document_stats(t) for t in byte_texts(b.column("text"))]
            counts = np.array([r[0] for r in rows], dtype=np.int64).reshape(len(rows), 5)
            x = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
            failed = base_failed(counts[:, 0], counts[:, 4])
            score = model.trees.proba(x) if model.trees is not None and len(x) else np.ones(len(x))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(counts[:, i]) for i in range(5)], pa.array(failed),
                 pa.array(~failed & model.accepts(x)), pa.array(score)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        judge, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents that are kept, all their columns unchanged (a narrow filter)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [document_stats(t) for t in byte_texts(b.column("text"))]
            x = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
            failed = np.array([base_failed(r[0][0], r[0][4]) for r in rows], dtype=bool)
            yield b.filter(pa.array(~failed & model.accepts(x)))

    return docs.mapInArrow(keep, docs.schema)
