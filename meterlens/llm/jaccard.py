"""N-gram Jaccard join through parity sketches.

A document's set holds its distinct k-word shingles.  Hashing every shingle
to a bit place and flipping that bit gives a parity sketch; the Hamming
distance of two sketches never exceeds the sets' symmetric difference.  Sets
that link at Jaccard t differ in at most ``d = (1-t)/(1+t) * (|A|+|B|)``
shingles, so if the places are dealt to more than d blocks, some block agrees.

* Size bands: a set joins in its own band, and in the band below when a
  partner there is large enough; each band has its own d and block count,
  chosen so that more than d blocks are non-empty but for a chance below
  ``POOR`` (the same order as a hash collision).  Empty blocks are no keys.
* Candidates: documents that share a block key.  Copies are folded first (by
  a 128-bit set fingerprint), keys are combined per slice of the input before
  they are shuffled.  Linking sets share all but d of a band's keys, so each
  keeps the d + 1 that fewest documents hold, and within a key only a star is
  proposed, around its most central document: the one that shares most of its
  keys, as the original of a group of edited copies does.  A short sketch then bounds the symmetric
  difference from below, and what remains is verified on the full sets.
* Components: a document is verified against the most central of its
  partners, and against the others only where they still lie in different
  components.  Then the documents that share a key of three or more, beside
  its centre, and still lie in different components meet once per centre;
  those whose sketches are close enough to link are verified too.  So no link that could join
  components is lost, and a group of copies or near copies never expands into
  all its pairs.

Edge cases: null and empty texts have an empty set and link with nothing;
rows without an id are returned with a null component; rows that repeat an
id are one document whose sets all count; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma, log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.util import as_text, mix64, slices, split_words, word_hash, written

#: Chance that a set has too few non-empty blocks in its band.
POOR = 1e-12
#: Blocks of a band at most; reached only by sets of two or three shingles at
#: similarities below 0.7, where POOR is then 1e-9.
MOST_BLOCKS = 1 << 31
#: Bits of the short sketch kept for the Hamming filter.
SKETCH_WORDS = 16
#: Text bytes handled at a time.
SLICE_BYTES = 4 << 20
#: Bits of a block key beside its bucket's number.
KEY_BITS = 40

_SEED = np.uint64(0x51ED270B7A1F3C25)
_STEP = np.uint64(0x9FB21C651E98DF25)
ONE = np.uint64(1)


# ---- shingle sets -----------------------------------------------------------------
def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each text's set and the end, sorted distinct 64-bit shingle hashes)."""
    starts, at, words = split_words(column, lower=True)
    h = word_hash(words)[at] if len(at) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        roll = np.zeros(len(h), np.uint64)
        for i in range(k):
            roll[: len(h) - i] = roll[: len(h) - i] * _STEP + h[i:]
        roll = mix64(roll)
        sets, size = [], np.zeros(len(starts), np.int64)
        for d, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            if b - a >= k:
                s = np.unique(roll[a:b - k + 1])
            elif b > a:  # fewer words: the whole sequence, marked by its length
                v = np.uint64(b - a)
                for x in h[a:b]:
                    v = v * _STEP + x
                s = mix64(np.array([v ^ _SEED], np.uint64))
            else:
                continue
            sets.append(s)
            size[d + 1] = len(s)
    return np.cumsum(size), np.concatenate(sets) if sets else np.zeros(0, np.uint64)


# ---- size bands -------------------------------------------------------------------
@lru_cache(maxsize=8)
def bands(largest: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size of each band, its d, its block count; 0 blocks where d is 0:
    only equal sets can link there)."""
    ratio = max(1.5, den / num)
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, int(np.ceil(first[-1] * ratio))))
    diff, blocks = [], []
    for low, high in zip(first, first[1:] + [int(np.ceil(first[-1] * ratio)) + 1]):
        n1 = high - 1
        d = (den - num) * (n1 + n1 * den // num) // (den + num)
        diff.append(d)
        blocks.append(_blocks(low, d) if d else 0)
    return np.array(first), np.array(diff), np.array(blocks)


def _blocks(n: int, d: int) -> int:
    """Fewest blocks B > d with  C(B, d) * (d / B) ** n  <=  POOR: then n
    places fill more than d of them but for that chance."""
    def poor(b: int) -> bool:
        return lgamma(b + 1) - lgamma(d + 1) - lgamma(b - d + 1) + n * (log(d) - log(b)) > log(POOR)
    low, high = d + 1, d + 2
    while high < MOST_BLOCKS and poor(high):
        low, high = high, min(MOST_BLOCKS, high * 2)
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if poor(mid) else (low, mid)
    return low


def block_keys(starts: np.ndarray, sets: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(set number, 64-bit key) of every non-empty block, in all bands of each set."""
    size = np.diff(starts)
    if not size.size or not size.max():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, _, blocks = bands(1 << int(size.max()).bit_length(), num, den)
    own = np.searchsorted(first, size, side="right") - 1
    smallest = -(-size * num // den)  # of a partner that could link
    out_set, out_key = [], []
    for below in (0, 1):
        band = own - below
        use = (size > 0) & (band >= 0)
        if below:
            use &= smallest < first[own]
        count = np.where(use, blocks[np.maximum(band, 0)], 0)
        picked = np.flatnonzero(count > 0)
        if not len(picked):
            continue
        n = size[picked]
        base = np.cumsum(count[picked]) - count[picked]
        mine = np.repeat(np.arange(len(picked)), n)
        index = np.arange(len(mine)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[picked], n)
        place = sets[index] >> np.uint64(32)  # the bit place of the shingle
        block = (place % count[picked][mine].astype(np.uint64)).astype(np.int64)
        value = mix64(place ^ _SEED)
        total = int(count[picked].sum())
        if total <= 4 * len(mine):
            parity = np.zeros(total, np.uint64)
            np.bitwise_xor.at(parity, base[mine] + block, value)
            owner = np.repeat(np.arange(len(picked)), count[picked])
            block = np.arange(total) - base[owner]
        else:  # few shingles over very many blocks, as small sets have
            group = (mine << 32) | block
            order = np.argsort(group, kind="stable")
            group, start = np.unique(group[order], return_index=True)
            parity = np.bitwise_xor.reduceat(value[order], start)
            owner, block = group >> 32, group & 0xFFFFFFFF
        salt = mix64((band[picked][owner].astype(np.uint64) << np.uint64(32)) + block.astype(np.uint64))
        full = parity != 0
        out_set.append(picked[owner[full]])
        # the lowest bit tells a set's own band from the one below
        out_key.append((mix64(parity[full] ^ salt[full]) & ~ONE) | (band[picked][owner[full]] & 1).astype(np.uint64))
    if not out_set:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_set), np.concatenate(out_key)


def spare_keys(starts: np.ndarray, owner: np.ndarray, key: np.ndarray, num: int, den: int) -> np.ndarray:
    """By set and lowest bit of the band: how many of its keys a set can do
    without.  A partner that links lacks at most d of them, so any d + 1 hold a
    common one; where all sets give up their most frequent keys in one order
    of all keys, the first common key in that order stays on both sides."""
    size = np.diff(starts)
    out = np.zeros((len(size), 2), np.int64)
    if not len(key):
        return out
    first, diff, _ = bands(1 << int(size.max()).bit_length(), num, den)
    own = np.searchsorted(first, size, side="right") - 1
    held = np.bincount(owner * 2 + (key & ONE).astype(np.int64), minlength=2 * len(size)).reshape(-1, 2)
    for below in (0, 1):
        band = np.maximum(own - below, 0)
        at = np.arange(len(size)), band & 1
        out[at] = np.maximum(held[at] - diff[band] - 1, 0)
    return out


def short_sketches(starts: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Parity bits of each set in ``64 * SKETCH_WORDS`` places."""
    n = len(starts) - 1
    out = np.zeros(n * SKETCH_WORDS, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(starts))
    word = ((sets >> np.uint64(6)) % np.uint64(SKETCH_WORDS)).astype(np.int64)
    np.bitwise_xor.at(out, owner * SKETCH_WORDS + word, np.uint64(1) << (sets & np.uint64(63)))
    return out.reshape(n, SKETCH_WORDS)


def bucketed(key: np.ndarray, buckets: int) -> np.ndarray:
    """Keys as their bucket's number and KEY_BITS of the hash.  Two keys that
    become one propose more candidates, never fewer; buckets grow with the input.
    The lowest bit stays."""
    value = (key >> np.uint64(64 - KEY_BITS) & ~ONE) | (key & ONE)
    return (((key >> np.uint64(1)) % np.uint64(buckets)) << np.uint64(KEY_BITS)) | value


def pack_numbers(x: np.ndarray) -> bytes:
    """64-bit integers compressed byte place by byte place: the high bytes of
    document ids and of the steps between sorted keys take next to nothing."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_numbers(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack_numbers(np.diff(x.astype(np.int64), prepend=0))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(blob))


# ---- pass one ---------------------------------------------------------------------
_PASS = ("kind int, doc long, n long, rep long, fp_a long, fp_b long, sketch array<long>, spare_0 int, spare_1 int, "
         "bucket int, keys binary, docs binary")
DOC, KEYS, SHARED = 0, 1, 2


def _sketch_pass(docs: DataFrame, k: int, num: int, den: int, buckets: int) -> DataFrame:
    """One narrow pass.  Rows by ``kind``: documents; one (key, smallest document)
    list per bucket; and the (key, document) rows of keys shared within a slice."""

    def rows(kind: int, count: int, /, **cols: pa.Array) -> pa.RecordBatch:
        types = {"kind": pa.int32(), "doc": pa.int64(), "n": pa.int64(), "rep": pa.int64(), "fp_a": pa.int64(),
                 "fp_b": pa.int64(), "sketch": pa.list_(pa.int64()), "spare_0": pa.int32(), "spare_1": pa.int32(), "bucket": pa.int32(), "keys": pa.binary(), "docs": pa.binary()}
        cols["kind"] = pa.array(np.full(count, kind, np.int32))
        return pa.RecordBatch.from_arrays([cols.get(c, pa.nulls(count, t)) for c, t in types.items()], list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            starts, sets = shingle_sets(b.column("text"), k)
            size = np.diff(starts)
            null = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            real = np.flatnonzero((size > 0) & ~null)
            fp = np.zeros((len(ids), 2), np.int64)
            with np.errstate(over="ignore"):
                if len(sets):
                    has = np.flatnonzero(size > 0)
                    fp[has, 0] = np.add.reduceat(mix64(sets), starts[:-1][has]).view(np.int64)
                    fp[has, 1] = np.bitwise_xor.reduceat(mix64(sets ^ _SEED), starts[:-1][has]).view(np.int64)
            # fold copies: the smallest id stands for its equals in this slice
            order = real[np.lexsort((ids[real], size[real], fp[real, 1], fp[real, 0]))]
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(fp[order, 0]) != 0) | (np.diff(fp[order, 1]) != 0) | (np.diff(size[order]) != 0)
            head = order[new]
            rep = ids.copy()
            rep[order] = ids[head][np.cumsum(new) - 1] if len(order) else rep[order]
            is_head = np.zeros(len(ids), bool)
            is_head[head] = True
            sketch = short_sketches(starts, sets)
            owner, key = block_keys(starts, sets, num, den)
            spare = spare_keys(starts, owner, key, num, den).astype(np.int32)
            yield rows(DOC, len(ids), doc=pa.array(ids, mask=null), n=pa.array(size), rep=pa.array(rep, mask=null),
                       spare_0=pa.array(spare[:, 0]), spare_1=pa.array(spare[:, 1]),
                       fp_a=pa.array(fp[:, 0], mask=~is_head), fp_b=pa.array(fp[:, 1], mask=~is_head),
                       sketch=pa.array([s if h else None for s, h in zip(sketch.view(np.int64), is_head)], pa.list_(pa.int64())))
            mine = is_head[owner]
            owner, key = owner[mine], bucketed(key[mine], buckets)
            if not len(key):
                continue
            doc = ids[owner]
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            start = np.concatenate([[True], key[1:] != key[:-1]])
            shared = ~start | np.concatenate([~start[1:], [False]])
            if shared.any():
                yield rows(SHARED, 1, keys=pa.array([pack_sorted(key[shared])], pa.binary()),
                           docs=pa.array([pack_numbers(doc[shared])], pa.binary()))
            key, doc = key[start], doc[start]
            full, at = np.unique((key >> np.uint64(KEY_BITS)).astype(np.int32), return_index=True)
            ends = [*at[1:].tolist(), len(key)]
            yield rows(KEYS, len(full), bucket=pa.array(full, pa.int32()),
                       keys=pa.array([pack_sorted(key[x:z]) for x, z in zip(at, ends)], pa.binary()),
                       docs=pa.array([pack_numbers(doc[x:z]) for x, z in zip(at, ends)], pa.binary()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PASS)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k, d in zip(b.column("keys").to_pylist(), b.column("docs").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(unpack_sorted(k)), pa.array(unpack_numbers(d))], ["key", "doc"])


def _shared_keys(keys: DataFrame, buckets: int) -> DataFrame:
    """(key, doc) of keys that several slices have.  A bucket holds one
    row per key and slice, and buckets grow in number with the shuffle width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in batches:
            k += [unpack_sorted(x) for x in b.column("keys").to_pylist()]
            d += [unpack_numbers(x) for x in b.column("docs").to_pylist()]
        key, doc = np.concatenate(k), np.concatenate(d)
        del k, d
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        start = np.ones(len(key), bool)
        start[1:] = key[1:] != key[:-1]
        shared = ~start
        shared[:-1] |= ~start[1:]
        for at in range(0, int(shared.sum()), 100_000):
            pick = np.flatnonzero(shared)[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(key[pick]), pa.array(doc[pick])], ["key", "doc"])

    return keys.repartition(buckets, "bucket").mapInArrow(run, "key long, doc long")


# ---- verification -----------------------------------------------------------------
def _close(a: str, b: str, num: int, den: int) -> Column:
    """Sizes and sketches of rows ``a`` and ``b`` leave room for a link: the
    Hamming distance is at most (den - num) / (den + num) of both sizes."""
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    apart = sum((F.bit_count(F.col(f"s_{a}")[i].bitwiseXOR(F.col(f"s_{b}")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return ((F.least(n_a, n_b) * den >= F.greatest(n_a, n_b) * num)
            & (apart * (den + num) <= (n_a + n_b) * (den - num)))


def _side(rows: DataFrame, x: str, *keep: Column | str) -> DataFrame:
    return rows.select(*keep, F.col("doc").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))


def _verified(left: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets link.  Texts travel rather than sets,
    which are larger and don't compress: once by id, once more with a pair to
    its ``b``; a task builds the set of each distinct text it sees."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(slices(batches, "text_a", SLICE_BYTES), "text_b", SLICE_BYTES):
            both = pa.concat_arrays([as_text(x.column("text_a")), as_text(x.column("text_b"))]).dictionary_encode()
            starts, sets = shingle_sets(both.dictionary, k)
            at = both.indices.to_numpy()
            keep = np.zeros(x.num_rows, bool)
            for i, (p, q) in enumerate(zip(at[:x.num_rows].tolist(), at[x.num_rows:].tolist())):
                p, q = sets[starts[p]:starts[p + 1]], sets[starts[q]:starts[q + 1]]
                same = np.intersect1d(p, q, assume_unique=True).size
                keep[i] = same > 0 and den * same >= num * (len(p) + len(q) - same)
            yield x.select(["a", "b"]).filter(pa.array(keep))

    for x in "ab":
        left = left.join(texts, F.col(x) == F.col("doc")).drop("doc").withColumnRenamed("text", f"text_{x}")
    return left.select("a", "b", "text_a", "text_b").mapInArrow(link, "a long, b long")


# ---- components -------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """``v, label``: the smallest vertex reachable from each vertex of ``edges``
    (``a, b``).  Labels spread along edges and jump to their label's label, so
    the rounds grow with the logarithm of a component's diameter."""
    both = written(edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")),
                                                  F.struct(F.col("b").alias("v"), F.col("a").alias("u")))).alias("e"))
                   .select("e.v", "e.u").distinct(), "edges")
    labels = written(both.groupBy("v").agg(F.least("v", F.min("u")).alias("label")), "labels")
    while True:
        # a vertex with very many edges is split by the join and pre-aggregated after it
        heard = (both.join(labels.select(F.col("v").alias("u"), F.col("label").alias("l")), "u")
                     .groupBy("v").agg(F.min("l").alias("l")))
        spread = labels.join(heard, "v").select("v", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("far"))
        new = written(spread.join(jump, "label", "left")
                            .select("v", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        changed = new.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels


def _kept(keys: str, bit: int) -> Column:
    """The keys of one band, from the rarest on, without the spare ones."""
    mine = F.filter(keys, lambda x: x["key"].bitwiseAND(F.lit(1)) == bit)
    return F.transform(F.slice(mine, F.lit(1), F.greatest(F.size(mine) - F.col(f"spare_{bit}"), F.lit(0))), lambda x: x["key"])


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``a, b`` (smaller first, once each) that lie in different components."""
    for x in "ab":
        named = labels.select(F.col("v").alias(x), F.col("label").alias(f"l_{x}"))
        pairs = pairs.join(named, x, "left").withColumn(f"l_{x}", F.coalesce(f"l_{x}", x))
    pairs = pairs.filter("l_a <> l_b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(edges: DataFrame, labels: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and labels after ``links``, which are computed once."""
    links = written(links, "jaccard-more")
    if not links.limit(1).count():
        return edges, labels
    edges = edges.unionByName(links)
    return edges, components(edges)


def _meetings(named: DataFrame) -> DataFrame:
    """``centre, group, doc, label``: where documents of ``named`` meet that lie in
    different components.  Copies share many keys around one centre, so all its
    documents meet once (group 0), unless meeting key by key takes fewer pairs."""
    keys = (named.groupBy("centre", "key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size"))
                 .filter("x <> y").select("centre", "key", F.col("size").cast("double").alias("size")))
    near = written(named.join(keys.select("centre", "key"), ["centre", "key"], "left_semi"), "jaccard-open")
    whole = (near.select("centre", "doc").distinct().groupBy("centre").agg(F.count(F.lit(1)).cast("double").alias("docs"))
                 .join(keys.groupBy("centre").agg(F.sum(F.col("size") * F.col("size")).alias("apart")), "centre")
                 .select("centre", (F.col("docs") * F.col("docs") <= F.col("apart")).alias("once")))
    return (near.join(whole, "centre")
                .select("centre", F.when(F.col("once"), 0).otherwise(F.col("key")).alias("group"), "doc", "label").distinct())


def _crossing(rest: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that meet, lie in different components and whose whole
    sketches leave room for a link, once each."""
    meet = ["centre", "group"]
    return (_side(rest, "a", *meet, F.col("label").alias("l_a")).join(_side(rest, "b", *meet, F.col("label").alias("l_b")), meet)
            .filter((F.col("l_a") != F.col("l_b")) & (F.col("a") < F.col("b")) & _close("a", "b", num, den))
            .select("a", "b").distinct())


def similar_documents(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``; documents link
    when ``den * |A and B| >= num * |A or B|`` (``num / den`` at least 1/2)."""
    if not 2 * num >= den >= num > 0:
        raise ValueError("the similarity must lie between 1/2 and 1")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = written(_sketch_pass(docs, k, num, den, buckets), "jaccard")
    rows = first.filter(F.col("kind") == DOC).select("doc", "n", "rep", "fp_a", "fp_b", "sketch", "spare_0", "spare_1")
    heads = rows.filter(F.col("sketch").isNotNull())
    # equal sets: one row per set and slice is left to meet here
    lows = heads.groupBy("fp_a", "fp_b", "n").agg(F.min("doc").alias("a"))
    equal = heads.join(lows, ["fp_a", "fp_b", "n"]).filter("a <> doc").select("a", F.col("doc").alias("b"))
    near = written(_shared_keys(first.filter(F.col("kind") == KEYS).select("bucket", "keys", "docs"), buckets), "jaccard-keys")
    local = first.filter(F.col("kind") == SHARED).select("keys", "docs").mapInArrow(_unpacked, "key long, doc long")
    member = local.unionByName(near)

    # one row per document: what is joined on documents moves keys, not rows.  Its
    # spare keys go, the most frequent first: those of passages that many texts
    # share; an id with several sets keeps all
    often = member.join(member.groupBy("key").agg(F.count(F.lit(1)).alias("often")), "key")
    spare = heads.groupBy("doc").agg(*[F.when(F.count(F.lit(1)) == 1, F.max(c)).otherwise(0).alias(c) for c in ("spare_0", "spare_1")])
    keyed = often.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("often", "key"))).alias("all")).join(spare, "doc")
    keyed = written(keyed.select("doc", F.size("all").alias("degree"), F.concat(_kept("all", 0), _kept("all", 1)).alias("keys")),
                    "jaccard-keyed")

    # a star in each key, around the document that shares most keys
    central = F.struct("degree", (-F.col("doc")).alias("minus"))
    centres = written(keyed.select(F.explode("keys").alias("key"), central.alias("best"))
                           .groupBy("key").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("size"))
                           .filter("size > 1").select("key", (-F.col("best.minus")).alias("centre"),
                                                      F.col("best.degree").alias("degree"), "size"), "jaccard-centres")
    spokes = written(keyed.select(F.explode("keys").alias("key"), "doc").join(centres, "key").filter("doc <> centre"),
                     "jaccard-spokes")
    stars = spokes.select("doc", "centre", "degree").distinct().withColumnsRenamed({"doc": "a", "centre": "b"})
    stars = written(stars.join(_side(heads, "a"), "a").join(_side(heads, "b"), "b").filter(_close("a", "b", num, den))
                         .select("a", "b", "degree").distinct(), "jaccard-stars")
    # an id's rows may stand under several representatives: all its sets count as one document's
    several = rows.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z").select("doc", "a")
    again = rows.join(several, "doc").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    # each document first meets its most central partner alone; its other pairs
    # are verified only where they would still join components
    best = stars.groupBy("a").agg(F.max(F.struct("degree", (-F.col("b")).alias("minus"))).alias("best"))
    best = written(best.select("a", (-F.col("best.minus")).alias("b")), "jaccard-best")
    edges = written(_verified(best, docs, k, num, den).unionByName(equal).unionByName(again), "jaccard-links")
    labels = components(edges)
    left = _apart(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), labels)
    edges, labels = _joined(edges, labels, _verified(written(left, "jaccard-left"), docs, k, num, den))

    # what a star can miss: close pairs of one key in different components, neither
    # of them the centre; of documents with equal sets the smallest speaks for all
    named = written(spokes.filter("size > 2").join(equal.select(F.col("b").alias("doc")), "doc", "left_anti")
                          .join(labels.withColumnRenamed("v", "doc"), "doc", "left")
                          .select("key", "centre", "doc", F.coalesce("label", "doc").alias("label")), "jaccard-named")
    rest = written(_meetings(named).join(heads.select("doc", "n", "sketch"), "doc"), "jaccard-rest")
    cross = _crossing(rest, num, den)
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    cross = written(cross.join(tested, ["a", "b"], "left_anti"), "jaccard-cross")
    edges, labels = _joined(edges, labels, _verified(cross, docs, k, num, den))
    out = rows.select("doc", "n", "rep").join(labels.withColumnRenamed("v", "rep"), "rep", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.coalesce("label", "rep").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document of each component (the smallest id), all its columns; of
    rows that repeat an id one stays; rows without an id stay as they are."""
    found = similar_documents(docs, k, num, den)
    kept = written(found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.col("doc_id").alias("_kept"), "rows"), "jaccard-kept")
    ids = docs.select("doc_id").columns
    key = docs["doc_id"].cast("long")
    single = docs.join(kept.filter("rows = 1"), key == F.col("_kept"), "left_semi")
    again = docs.join(kept.filter("rows > 1"), key == F.col("_kept"), "left_semi").dropDuplicates(ids)
    return single.unionByName(again).unionByName(docs.filter(F.col("doc_id").isNull()))
