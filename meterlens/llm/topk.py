"""Exact top-k inner-product search with paged M-trees.

Vectors become integers ``floor(256 * x)``.  With one more coordinate that
brings every vector of a tree to the same norm, the largest inner product is
the smallest Euclidean distance, so metric bounds apply.  Every slice of the
input becomes one tree: leaf pages of at most ``PAGE`` vectors with a routing
vector, a covering radius and each entry's distance to it, below inner nodes
with the same.  A block of queries is searched best first: a node is entered
only if its distance less its radius can beat the query's k-th score so far,
and |d(query, parent) - d(entry, parent)| rules entries out before any
product with them is computed.  Scores are exact integers: products of floats
where all sums stay below 2^23, of doubles below 2^52, of longs below 2^62, of
Python integers beyond; bounds carry a slack far above their rounding.

All rows are searched for all queries.  Vectors travel as pieces of at most
``PIECE`` bytes, in the smallest number type that holds them; a task takes about
``PIECES`` of them, builds its trees and lets all blocks of queries pass, one at
a time and each from tree to tree with its k-th scores.  So no row, batch of a
reader or join grows with the input, the driver gets one count, and per task
only k rows a query go on to the final ranking.

Edge cases: vectors that are null, or hold null or non-finite components,
take no part; neither do rows without an id; shorter vectors count as padded
with zeros; rows that repeat a query's id are not its candidates, and one of
them (the smallest vector) is the query; equal scores rank by the smaller
id; with fewer than k candidates all are returned; an empty table gives no rows;
a component too large for ``256 * x`` in a double counts as non-finite; ranks
are exact for all others, and a score beyond a long is returned as the nearest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
EVERY = 50
LONG = 2 ** 63 - 1
TOP = 5
#: Vectors of a leaf page, pages of an inner node, vectors of a tree, queries of a block.
PAGE, FANOUT, TREE, BLOCK = 128, 16, 16_384, 512
#: Bytes of vectors in a row, such rows in a task, components that are worked on at once.
PIECE, PIECES, WORK = 1 << 16, 256, 1 << 20
#: Number types of a piece by their bytes.
KINDS = {1: "<i1", 2: "<i2", 4: "<i4", 8: "<f8"}
MISSING = -2 ** 62  # below every score that is not a Python integer


def _integers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of the rows that take part; a floor of a double is a double, so nothing is lost."""
    lists = batch.column("embedding")
    ok = pc.and_(lists.is_valid(), batch.column("vec_id").is_valid())
    batch = batch.filter(ok)
    lists = pa.concat_arrays([batch.column("embedding")])
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    dim = int(size.max()) if len(size) else 0
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    x = np.zeros((len(size), dim))
    x[row, place] = flat
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * SCALE)
    good = np.isfinite(x).all(axis=1)
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
    return ids[good], x[good]


def _lifted(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The vectors with one more coordinate that makes all norms equal, and the square of that norm."""
    f = x.astype(np.float64)
    norm = (f * f).sum(axis=1)
    most = float(norm.max()) if len(norm) else 0.0
    return np.column_stack([f, np.sqrt(np.maximum(most - norm, 0))]), most


def _split(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Groups of at most ``most`` near points: halves by the nearer of two far pivots."""
    out, work = [], [np.arange(len(points))]
    while work:
        idx = work.pop()
        if len(idx) <= most:
            out.append(idx)
            continue
        p = points[idx]
        a = p[((p - p.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        b = p[((p - a) ** 2).sum(axis=1).argmax()]
        lean = ((p - a) ** 2).sum(axis=1) - ((p - b) ** 2).sum(axis=1)
        order = np.argsort(lean, kind="stable")
        cut = int(np.clip((lean < 0).sum(), len(idx) // 4, len(idx) - len(idx) // 4))
        work += [idx[order[:cut]], idx[order[cut:]]]
    return out


class Tree:
    """Pages and inner nodes over the vectors of one slice, which lie page by page, near entries first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        points, self.norm = _lifted(x)
        pages, entry, pivot = [], [], []
        for p in _split(points, PAGE):
            c = points[p].mean(axis=0)
            d = np.sqrt(((points[p] - c) ** 2).sum(axis=1))
            near = np.argsort(d, kind="stable")
            pages.append(p[near])
            entry.append(d[near])
            pivot.append(c)
        at = np.concatenate(pages)
        self.start = np.cumsum([0, *map(len, pages)])
        self.largest = int(np.abs(x).max()) if x.size else 0
        self.ids, self.x = ids[at], x[at].astype(np.float32 if self.largest < 2 ** 24 else np.float64)
        self.pivot, self.entry = np.array(pivot), entry
        self.radius = np.array([d.max() for d in self.entry])
        self.nodes = _split(self.pivot, FANOUT)
        self.node_pivot = np.array([self.pivot[n].mean(axis=0) for n in self.nodes])
        self.page_parent = [np.sqrt(((self.pivot[n] - c) ** 2).sum(axis=1)) for n, c in zip(self.nodes, self.node_pivot)]
        self.node_radius = np.array([(d + self.radius[n]).max() for n, d in zip(self.nodes, self.page_parent)])

    def improve(self, ids: np.ndarray, q: np.ndarray, best: Best) -> None:
        """Let ``best`` of the queries have what is better here."""
        wide = self.x.shape[1]
        qf = np.column_stack([q[:, :wide].astype(np.float64), np.zeros(len(q))])
        qs = best.cast(q[:, :wide])
        own = (qf * qf).sum(axis=1)
        slack = 1e-5 * (1 + np.sqrt(own + self.norm))
        reach = np.empty(len(q))  # distance of the k-th best, with slack

        def reset(rows: np.ndarray) -> None:
            last = best.score[rows, -1]
            gap = np.where(last > best.lowest, own[rows] + self.norm - 2 * last.astype(np.float64), np.inf)
            reach[rows] = np.sqrt(np.maximum(gap, 0)) + slack[rows]

        def distance(rows: np.ndarray, p: np.ndarray) -> np.ndarray:
            square = own[rows][:, None] + (p * p).sum(axis=1)[None, :] - 2 * (qf[rows] @ p.T)
            return np.sqrt(np.maximum(square, 0))

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, scores and ids that have not met the best yet

        def settle() -> None:
            if held:
                reset(best.merge(*(np.concatenate(part) for part in zip(*held))))
                held.clear()

        def scan(page: int, rows: np.ndarray, asked: np.ndarray, d: np.ndarray) -> None:
            far = reach[rows]
            entry = self.entry[page]
            a = self.start[page] + np.searchsorted(entry, (d - far).min())
            b = self.start[page] + np.searchsorted(entry, (d + far).max(), side="right")
            s = asked @ best.cast(self.x[a:b]).T
            r, c = np.divmod(np.flatnonzero(s >= best.score[rows, -1:].astype(s.dtype)), max(1, b - a))
            at, found = rows[r], self.ids[a + c]
            other = found != ids[at]
            if other.any():
                held.append((at[other], s[r, c][other], found[other]))
                if sum(len(part) for part, _, _ in held) > len(q):
                    settle()

        def enter(node: int, rows: np.ndarray) -> None:
            rows = rows[low[rows, node] <= reach[rows]]
            if not len(rows):
                return
            pages, asked = self.nodes[node], qs[rows]
            bound = np.abs(d_node[rows, node][:, None] - self.page_parent[node][None, :]) - self.radius[pages]
            dp = distance(rows, self.pivot[pages])
            for i in np.argsort(bound.mean(axis=0)):
                near = (bound[:, i] <= reach[rows]) & (dp[:, i] - self.radius[pages[i]] <= reach[rows])
                if near.all():
                    scan(int(pages[i]), rows, asked, dp[:, i])
                elif near.any():
                    scan(int(pages[i]), rows[near], asked[near], dp[near, i])
            settle()

        every = np.arange(len(q))
        reset(every)
        d_node = distance(every, self.node_pivot)
        low = d_node - self.node_radius
        first = low.argmin(axis=1)
        for node in np.unique(first):  # each query's most promising node, then whatever its bound still admits
            enter(node, every[first == node])
        for node in np.argsort(low.mean(axis=0)):
            enter(node, every[first != node])


class Best:
    """The best ``top`` scores and ids of each query so far, in the number type that holds all scores."""

    def __init__(self, queries: int, top: int, most: int) -> None:
        self.kind = np.float32 if most < 2 ** 23 else np.float64 if most < 2 ** 52 else np.int64 if most < 2 ** 62 else object
        self.lowest = -math.inf if self.kind is object else MISSING  # below every score; what has it is missing
        self.score = np.full((queries, top), self.lowest, dtype=object if self.kind is object else np.int64)
        self.found = np.zeros((queries, top), dtype=np.int64)

    def cast(self, x: np.ndarray) -> np.ndarray:
        if self.kind is object:
            return np.array([[int(c) for c in row] for row in x.tolist()], dtype=object).reshape(x.shape)
        return x.astype(self.kind, copy=False)

    def merge(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Candidates of the queries ``at`` join the best; the queries that had some."""
        by = np.argsort(at, kind="stable")
        score, ids = score[by], ids[by]
        which, count = np.unique(at, return_counts=True)
        top = self.score.shape[1]
        line = np.repeat(np.arange(len(which)), count)
        place = top + np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
        all_s = np.full((len(which), top + count.max()), self.lowest, dtype=self.score.dtype)
        all_i = np.zeros(all_s.shape, dtype=np.int64)
        all_s[:, :top], all_i[:, :top] = self.score[which], self.found[which]
        all_s[line, place], all_i[line, place] = score.astype(self.score.dtype), ids
        order = self._order(all_s, all_i, top)
        self.score[which] = np.take_along_axis(all_s, order, axis=1)
        self.found[which] = np.take_along_axis(all_i, order, axis=1)
        return which

    @staticmethod
    def _order(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
        """Places of the ``top`` largest scores of each row, ties by id."""
        if scores.dtype == object:
            return np.array([sorted(range(len(i)), key=lambda c: (-s[c], i[c]))[:top]  # noqa: B023
                             for s, i in zip(scores.tolist(), ids.tolist())])
        return np.lexsort((ids, -scores), axis=-1)[:, :top]


def _search(trees: list[Tree], ids: np.ndarray, q: np.ndarray, top: int) -> Best:
    """The best ``top`` per query over all trees."""
    dim = max(q.shape[1], *(t.x.shape[1] for t in trees))
    q = np.pad(q, ((0, 0), (0, dim - q.shape[1])))
    largest, asked = max(t.largest for t in trees), int(np.abs(q).max(initial=0))
    best = Best(len(ids), top, max(dim * largest * asked, largest, asked))
    for tree in trees:
        tree.improve(ids, q, best)
    return best


def _sort_key(score: int) -> bytes:
    """Bytes that compare as the integers do, whatever their size."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return (32768 + size).to_bytes(2, "big") + score.to_bytes(size, "big")
    return (32767 - size).to_bytes(2, "big") + bytes(255 - b for b in (-score).to_bytes(size, "big"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``WORK`` components at once when padded (or one row)."""
    size = pc.fill_null(pc.list_value_length(batch.column("embedding")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < batch.num_rows:
        padded = np.maximum.accumulate(size[at:]) * np.arange(1, len(size) - at + 1)
        n = max(1, int(np.searchsorted(padded, WORK, side="right")))
        yield batch.slice(at, n)
        at += n


def _packed(vectors: DataFrame, rows_each: int) -> DataFrame:
    """``ids, x, dim, item``: at most ``rows_each`` vectors and ``PIECE`` bytes of them (or one vector) a row,
    in the number type of ``item`` bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                ids, x = _integers(part)
                low, high = x.min(initial=0), x.max(initial=0)
                item = next((n for n in (1, 2, 4) if -2 ** (8 * n - 1) <= low and high < 2 ** (8 * n - 1)), 8)
                step = min(rows_each, max(1, PIECE // max(1, item * x.shape[1])))
                for at in range(0, len(ids), step):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[at:at + step].astype("<i8").tobytes()], pa.binary()),
                         pa.array([x[at:at + step].astype(KINDS[item]).tobytes()], pa.binary()),
                         pa.array([x.shape[1]], pa.int32()), pa.array([item], pa.int32())], ["ids", "x", "dim", "item"])

    return vectors.select("vec_id", "embedding").mapInArrow(pack, "ids binary, x binary, dim int, item int")


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    dim = max(x.shape[1] for _, x in parts)
    return np.concatenate([i for i, _ in parts]), np.concatenate([np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for _, x in parts])


def _results(ids: np.ndarray, best: Best) -> pa.RecordBatch:
    hit = best.score > best.lowest
    score = best.score[hit]
    exact = [_sort_key(v) if abs(v) >= LONG else None for v in score.tolist()] if score.dtype == object else [None] * len(score)
    if score.dtype == object:
        score = np.array([max(-LONG, min(LONG, v)) for v in score.tolist()], dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, hit.sum(axis=1))), pa.array(best.found[hit]), pa.array(score),
                                       pa.array(exact, pa.binary())], ["query_id", "vec_id", "score", "exact"])


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's best vectors."""
    from meterlens.llm.util import written
    most, block = TREE, BLOCK  # the workers' copies of this module have their own
    valid = queries.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                           & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    asked = valid.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # A reader takes whole row groups of few rows at once, so they are kept short.
    pieces = written(_packed(vectors, most).withColumn("place", F.monotonically_increasing_id()), "topk-pieces",
                     {"parquet.block.row.count.limit": "64"})
    count = pieces.count()
    tasks = max(1, -(-count // PIECES), min(count, 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    # Pieces of a file go to tasks in turn, from a start that differs from file to file and spreads evenly.
    start = F.floor((F.shiftright("place", 33) * F.lit(0.6180339887498949) % 1) * tasks)
    task = ((start + F.col("place").bitwiseAND(2 ** 33 - 1)) % tasks).cast("int")
    blocks = _packed(asked, block).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    columns = ["task", "asks", "ids", "x", "dim", "item"]
    both = (pieces.withColumn("task", task).withColumn("asks", F.lit(False)).select(*columns)
                  .unionByName(blocks.withColumn("asks", F.lit(True)).select(*columns)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees = None, []
        held: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {False: [], True: []}
        full = {False: lambda n, dim: n >= most or n * dim >= WORK, True: lambda n, dim: n >= block}

        def take(asks: bool) -> Iterator[pa.RecordBatch]:
            """What is held becomes a tree, or is searched in the trees."""
            if not held[asks]:
                return
            ids, x = _joined(held[asks])
            held[asks].clear()
            if not asks:
                trees.append(Tree(ids, x))
            elif trees:
                yield _results(ids, _search(trees, ids, x, top))

        for b in batches:
            for r in range(b.num_rows):
                key, asks, dim, item = (b.column(c)[r].as_py() for c in ("task", "asks", "dim", "item"))
                if key != now:
                    yield from take(False)
                    yield from take(True)
                    now = key
                    trees.clear()
                if asks:
                    yield from take(False)
                ids = np.frombuffer(b.column("ids")[r].as_buffer(), "<i8")
                x = np.frombuffer(b.column("x")[r].as_buffer(), KINDS[item]).reshape(len(ids), dim).astype(np.float64)
                held[asks].append((ids, x))
                if full[asks](sum(len(i) for i, _ in held[asks]), max(p.shape[1] for _, p in held[asks])):
                    yield from take(asks)
        yield from take(False)
        yield from take(True)

    got = (both.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "asks")
               .mapInArrow(search, "query_id long, vec_id long, score long, exact binary"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("exact"), "vec_id"))
    return (got.withColumn("rank", rank).filter(F.col("rank") <= top)
               .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


#: The same search in DuckDB SQL, by brute force.
ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER
    (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}
"""
