"""Toxicity: class-conditional Kneser-Ney models with shared backoff counts.

Two interpolated bigram models, toxic and ordinary, are counted by grouped
aggregation over a bounded sample of labelled documents.  Each discounts its
own bigrams, backs off to its own discounted counts of the word and then of the
word's first six and four bytes (inflected forms of one stem), and those back
off to *one* continuation distribution counted over both classes, so an
expression rare in either class is not evidence by itself.  A document's
evidence is the length-normalised difference of the two log-likelihoods,
over the whole text and over its most toxic window of eight words; a
logistic calibration, fitted on sampled documents that were not counted,
turns it into a score.

Words here are runs between ASCII white space, digits and punctuation, A-Z
lower-cased.  ``labels``, ``lang``, ``source`` and ids are never score inputs.

Edge cases: null and empty texts carry no evidence and get the score of a
text without words; null ids are in the training fold and get a row; repeated
rows get a row each; an empty table gives no rows; other columns are ignored.
Without toxic and ordinary training labels every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.util import bounded_labels, byte_texts, fold, labelled_texts, slices

#: Bounds of the labelled sample (rows of smallest id hash).
FIT_TOXIC = 4_000
FIT_ORDINARY = 8_000
#: Stem lengths in bytes, tried in this order for a word that is not known.
STEMS = (6, 4)
#: A word, stem or bigram enters the model from this many occurrences;
#: below, it backs off.
MIN_WORD = 2
MIN_BIGRAM = 3
DISCOUNT = 0.75
WINDOW = 8
HELD_OUT_MOD, HELD_OUT = 4, 2
THRESHOLD = 0.3

_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 97 or 122 < c < 128 else c for c in range(256))
_CHUNK_WORDS = 200_000


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def in_training(doc_id: Column) -> Column:
    return fold(doc_id, HELD_OUT_MOD) != HELD_OUT


@dataclass(frozen=True)
class KneserNey:
    ids: dict[bytes, int]   # known word -> id
    stems: tuple[dict[bytes, int], ...]  # per length in STEMS: known stem -> id; all else is id 0
    word: np.ndarray        # log Q_toxic(w) - log Q_ordinary(w)
    context: np.ndarray     # log of the two backoff weights' ratio
    pairs: np.ndarray       # sorted keys  v * size + w
    pair: np.ndarray        # log P_toxic(w|v) - log P_ordinary(w|v)

    def unknown(self, word: bytes) -> int:
        for size, ids in zip(STEMS, self.stems):
            got = ids.get(word[:size])
            if got:
                return got
        return 0

    def ratios(self, cur: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each token; ``first`` marks text starts."""
        prev = np.empty_like(cur)
        prev[1:] = cur[:-1]
        prev[first] = 1  # the start marker
        out = self.word[cur] + self.context[prev]
        if len(self.pairs):
            key = prev * len(self.word) + cur
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[at] == key
            out[hit] = self.pair[at[hit]]
        return out


FEATURES = 6


def features(model: KneserNey, texts: list[bytes]) -> np.ndarray:
    """Per text: mean ratio, best window mean, best token, excess above 2,
    tokens above 3, log length (all 0 for a text without words)."""
    out = np.zeros((len(texts), FEATURES))
    get, unknown = model.ids.get, model.unknown

    def flush(rows: list[int], sizes: list[int], ids: list[int]) -> None:
        cur = np.array(ids, dtype=np.int64)
        size = np.array(sizes)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        m = model.ratios(cur, start)
        total = np.concatenate([[0.0], np.cumsum(m)])
        at = np.arange(len(cur))
        low = np.maximum(at - WINDOW + 1, np.repeat(start, size))
        width = np.repeat(np.minimum(size, WINDOW), size)
        window = (total[1:] - total[low]) / width
        out[rows, 0] = np.add.reduceat(m, start) / size
        out[rows, 1] = np.maximum.reduceat(window, start)
        out[rows, 2] = np.maximum.reduceat(m, start)
        out[rows, 3] = np.log1p(np.add.reduceat(np.maximum(m - 2, 0), start))
        out[rows, 4] = np.log1p(np.add.reduceat((m > 3).astype(float), start))
        out[rows, 5] = np.log1p(size)

    rows: list[int] = []
    sizes: list[int] = []
    ids: list[int] = []
    for i, text in enumerate(texts):
        words = tokens(text)
        if not words:
            continue
        rows.append(i)
        sizes.append(len(words))
        ids.extend([get(w) or unknown(w) for w in words])
        if len(ids) >= _CHUNK_WORDS:
            flush(rows, sizes, ids)
            rows, sizes, ids = [], [], []
    if rows:
        flush(rows, sizes, ids)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    kn: KneserNey | None
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.kn is None or not texts:
            return np.zeros(len(texts))
        x = (features(self.kn, texts) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigram counts by class of a partition, flushed at a bounded size."""

    def rows(toxic: Counter, ordinary: Counter) -> pa.RecordBatch:
        grams = list(toxic.keys() | ordinary.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array([g[0] for g in grams], pa.binary()), pa.array([g[1] for g in grams], pa.binary()),
             pa.array([toxic[g] for g in grams], pa.int64()), pa.array([ordinary[g] for g in grams], pa.int64())],
            ["v", "w", "t", "o"])

    counts = (Counter(), Counter())  # ordinary, toxic
    for b in batches:
        for text, y in zip(byte_texts(b.column("text")), b.column("y").to_pylist()):
            words = tokens(text)
            counts[1 if y else 0].update(zip([b""] + words, words))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield rows(counts[1], counts[0])
                counts = (Counter(), Counter())
    yield rows(counts[1], counts[0])


def fit_kneser_ney(sample: DataFrame) -> KneserNey | None:
    """Count ``sample`` (``text, y``) and build the two models' log ratios."""
    grams = (sample.select("text", "y").mapInArrow(_count_bigrams, "v binary, w binary, t long, o long")
                   .groupBy("v", "w").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))).persist()
    try:
        words = (grams.groupBy("w").agg(F.sum("t").alias("t"), F.sum("o").alias("o"),
                                        F.count(F.lit(1)).alias("cont")))
        tot = words.agg(F.sum("t"), F.sum("o"), F.count_if(F.col("t") > 0), F.count_if(F.col("o") > 0),
                        F.sum("cont"), F.count(F.lit(1))).first()
        if not tot[0] or not tot[1]:
            return None
        n_t, n_o, k_t, k_o, cont, size = map(float, tot)
        counts = [F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum("cont").alias("cont"),
                  F.count(F.lit(1)).alias("kinds")]
        seen = F.col("t") + F.col("o") >= MIN_WORD
        uni = words.filter(seen).toArrow().sort_by("w")
        stems, stem_kinds = [], []
        for size in STEMS:
            level = words.groupBy(F.substring("w", 1, size).alias("w")).agg(*counts)
            stem_kinds.append(level.agg(F.count_if(F.col("t") > 0), F.count_if(F.col("o") > 0)).first())
            stems.append(level.filter(seen).toArrow().sort_by("w"))
        ctx = (grams.groupBy("v").agg(F.sum("t").alias("t"), F.sum("o").alias("o"),
                                      F.count_if(F.col("t") > 0).alias("kt"), F.count_if(F.col("o") > 0).alias("ko"))
                    .filter(F.col("t") + F.col("o") >= MIN_WORD).toArrow())
        big = grams.filter(F.col("t") + F.col("o") >= MIN_BIGRAM).toArrow()
    finally:
        grams.unpersist()
    col = lambda tab, c: tab.column(c).to_numpy().astype(np.float64)
    names = [bytes(w) for w in uni.column("w").to_pylist()]
    ids = {w: i + 2 for i, w in enumerate(names)}  # 0: unknown, 1: start of text
    base = len(names) + 2
    # from the shortest stem up: the parent's probability times the shared
    # chance of the child given its parent, plus the class's own counts
    parents: dict[bytes, int] = {}
    parent_t, parent_o = np.array([1.0]), np.array([1.0])
    parent_cont, parent_kinds = np.array([cont]), np.array([size])
    tables = [(uni, (k_t, k_o), None)] + [(s, tuple(map(float, k)), n) for s, k, n in zip(stems, stem_kinds, STEMS)]
    q: list[tuple[np.ndarray, np.ndarray]] = []
    stem_names: list[list[bytes]] = []
    for level in range(len(tables) - 1, -1, -1):
        tab, (kt, ko), _ = tables[level]
        grams_at = [bytes(w) for w in tab.column("w").to_pylist()]
        above = STEMS[level] if level < len(STEMS) else None
        at = np.array([parents.get(w[:above], 0) if above else 0 for w in grams_at], dtype=np.int64)
        t, o, c = col(tab, "t"), col(tab, "o"), col(tab, "cont")
        share = (c + 0.5) / (parent_cont[at] + 0.5 * (parent_kinds[at] + 1))
        rest = 0.5 / (parent_cont[0] + 0.5 * (parent_kinds[0] + 1))
        q_t = np.maximum(t - DISCOUNT, 0) / n_t + DISCOUNT * kt / n_t * parent_t[at] * share
        q_o = np.maximum(o - DISCOUNT, 0) / n_o + DISCOUNT * ko / n_o * parent_o[at] * share
        # index 0: nothing of this level is known
        q_t = np.concatenate([[DISCOUNT * kt / n_t * parent_t[0] * rest], q_t])
        q_o = np.concatenate([[DISCOUNT * ko / n_o * parent_o[0] * rest], q_o])
        if level:
            parents = {w: i + 1 for i, w in enumerate(grams_at)}
            parent_t, parent_o = q_t, q_o
            parent_cont = np.concatenate([[cont], c])
            parent_kinds = np.concatenate([[size], col(tab, "kinds")])
            stem_names.insert(0, grams_at)
            q.insert(0, (q_t[1:], q_o[1:]))
        else:
            word_t, word_o = q_t, q_o
    back_t, back_o = DISCOUNT * k_t / n_t, DISCOUNT * k_o / n_o  # an unknown word of a known stem
    stem_ids, at = [], base
    for names_at in stem_names:
        stem_ids.append({w: at + i for i, w in enumerate(names_at)})
        at += len(names_at)
    q_t = np.concatenate([word_t[:1], word_t[:1], word_t[1:], *[x[0] * back_t for x in q]])
    q_o = np.concatenate([word_o[:1], word_o[:1], word_o[1:], *[x[1] * back_o for x in q]])
    v = len(q_t)

    def back(total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        return np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)

    full = {w: i for i, w in enumerate(names, 2)} | {b"": 1}
    at = np.array([full.get(bytes(x), 0) for x in ctx.column("v").to_pylist()], dtype=np.int64)
    b_t, b_o, n_vt, n_vo = np.ones(v), np.ones(v), np.zeros(v), np.zeros(v)
    b_t[at], b_o[at] = back(col(ctx, "t"), col(ctx, "kt")), back(col(ctx, "o"), col(ctx, "ko"))
    n_vt[at], n_vo[at] = col(ctx, "t"), col(ctx, "o")
    for a in (b_t, b_o):
        a[0] = 1.0
    pv = np.array([full.get(bytes(x), 0) for x in big.column("v").to_pylist()], dtype=np.int64)
    pw = np.array([ids.get(bytes(x), 0) for x in big.column("w").to_pylist()], dtype=np.int64)
    p_t = np.maximum(col(big, "t") - DISCOUNT, 0) / np.maximum(n_vt[pv], 1) + b_t[pv] * q_t[pw]
    p_o = np.maximum(col(big, "o") - DISCOUNT, 0) / np.maximum(n_vo[pv], 1) + b_o[pv] * q_o[pw]
    ok = (pv > 0) & (pw > 0)
    key, ratio = (pv * v + pw)[ok], (np.log(p_t) - np.log(p_o))[ok]
    order = np.argsort(key)
    return KneserNey(ids, tuple(stem_ids), np.log(q_t) - np.log(q_o), np.log(b_t) - np.log(b_o), key[order], ratio[order])


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1.0) -> np.ndarray:
    x1 = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], l2)
    ridge[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        g = x1.T @ (w * (p - y)) + ridge * beta
        h = (x1 * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(h, g)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_toxicity(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> ToxicityModel:
    """``keep`` restricts the labelled ids that may be learnt from."""
    none = ToxicityModel(None, np.zeros(FEATURES + 1), np.zeros(FEATURES), np.ones(FEATURES))
    toxic = F.col("toxic") == 1
    train = keep if keep is not None else F.lit(True)
    sample = bounded_labels(labels.filter(toxic), "toxic", FIT_TOXIC, train).unionByName(
        bounded_labels(labels.filter(F.col("toxic") == 0), "toxic", FIT_ORDINARY, train))
    share = (labels.filter(train).agg(F.count_if(toxic).alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))).first()
    if not share["t"] or not share["o"]:
        return none
    rows = labelled_texts(docs, sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)))
    kn = fit_kneser_ney(rows.filter(F.col("part") != 3))
    if kn is None:
        return none
    names = [f"x{i}" for i in range(FEATURES)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(kn, byte_texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("y"), *[pa.array(x[:, i]) for i in range(FEATURES)]],
                                             ["y", *names])

    got = (rows.filter(F.col("part") == 3).select("text", "y")
               .mapInArrow(measure, "y int, " + ", ".join(f"{n} double" for n in names)).toArrow())
    y = got.column("y").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return none
    x = np.column_stack([got.column(n).to_numpy() for n in names])
    x, y = x[np.lexsort(x.T)], y[np.lexsort(x.T)]  # independent of the order of arrival
    centre, scale = x.mean(0), x.std(0) + 1e-9
    # the sample is drawn by class: weigh it back to the labels' own shares
    w = np.where(y == 1, share["t"] / max(1.0, y.sum()), share["o"] / max(1.0, (1 - y).sum()))
    return ToxicityModel(kn, _logistic((x - centre) / scale, y, w * len(y) / w.sum()), centre, scale)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document (a narrow pass)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            s = model.scores(byte_texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return out.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents not predicted toxic, all their columns unchanged."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield b.filter(pa.array(model.scores(byte_texts(b.column("text"))) < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
