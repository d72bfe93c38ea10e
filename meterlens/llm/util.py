"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.config import checkpoint_dir

#: ASCII white space, the separators of "words" in every operator here
#: (``bytes.split()`` without arguments splits on exactly these).
WHITE = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts lineage, survives executor loss, computes ``df`` once."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/meterlens-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def str_texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def bounded_labels(labels: DataFrame, label: str, limit: int, keep: Column | None = None) -> DataFrame:
    """At most ``limit`` labelled ids, those of smallest hash (``doc_id, y``).

    The bound makes the result safe to broadcast and a fit on it safe to
    collect.  Repeated ids count once (the larger label); null ids or labels
    are left out.
    """
    rows = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    if keep is not None:
        rows = rows.filter(keep)
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, text, y`` of the sampled ids; ``sample`` is bounded by
    construction, so it is broadcast."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return d.join(F.broadcast(sample), "doc_id")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` text bytes (or one row),
    so that a worker's memory does not depend on how long the texts are.
    What Arrow holds of earlier slices goes back to the system."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
            yield b.slice(at, end - at)
            pa.default_memory_pool().release_unused()
            at = end


def as_text(column: pa.Array) -> pa.Array:
    """Null texts as empty ones, without the offset of a slice."""
    return pa.concat_arrays([pc.fill_null(column, "")])


def split_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text: (start of each text in ``ids`` and the end, word ids
    in text order, the distinct words).  Runs in Arrow, not per word in Python."""
    text = as_text(column)
    if lower:
        text = lower_ascii(text)
    lists = pc.ascii_split_whitespace(text)
    words, starts = lists.values, lists.offsets.to_numpy().astype(np.int64)
    full = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty word
    if not full.all():
        starts = np.concatenate([[0], np.cumsum(full)])[starts]
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return starts, coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(text: pa.Array) -> pa.Array:
    """A-Z lower-cased and nothing else: a byte table over the data buffer."""
    valid, offsets, data = text.buffers()
    if data is None or not data.size:
        return text
    return pa.Array.from_buffers(text.type, len(text),
                                 [valid, offsets, pa.py_buffer(_LOWER[np.frombuffer(data, np.uint8)])])


def pack_bytes(values: pa.Array) -> bytes:
    """A binary array as one compressed blob (its size, lengths, data)."""
    values = pa.concat_arrays([values])
    n = pc.binary_length(values).to_numpy().astype("<u4")
    data = values.buffers()[2]
    head = np.array([len(n)], "<u4").tobytes() + n.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + (data.to_pybytes()[: int(n.sum())] if data else b""))


def unpack_bytes(blob: bytes) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.zeros(size + 1, np.int32)
    np.cumsum(np.frombuffer(raw, "<u4", size, 4), out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(ends), pa.py_buffer(raw[4 + 4 * size:])])


def word_hash(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, computed over the whole array at once:
    a sum of mixed (byte, place) pairs, mixed again with the length."""
    words = pa.concat_arrays([words])
    n = pc.binary_length(words).to_numpy().astype(np.int64)
    out = mix64(n.astype(np.uint64))
    if not n.sum():
        return out
    data = np.frombuffer(words.buffers()[2], np.uint8)[: int(n.sum())]
    start = np.cumsum(n) - n
    place = np.arange(len(data)) - np.repeat(start, n)
    mixed = mix64(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)))
    full = n > 0
    out[full] ^= np.add.reduceat(mixed, start[full])
    return mix64(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
