"""Packing: concatenate and cut.

Pass one encodes every document once and writes its ids with its running
offset inside the partition.  The partition totals (one row per task) are
prefix-summed; partition offset plus running offset is a document's place in
the global stream.  Pass two cuts the stream every ``SEQUENCE`` ids; a
document that crosses a cut yields one boundary record per sequence.  Only
the stream's last sequence can be short, so padding is below one sequence.
Nothing is shuffled but the totals, and no task holds more than a batch.

Edge cases: null and empty texts are the single closing id; null ids get
pieces with a null id; repeated rows are packed each; an empty table gives
no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.bytebpe import BYTE_BPE, byte_bpe, public_path
from meterlens.llm.util import slices, written

SEQUENCE = 2048
CLOSING_ID = 1


def encode_documents(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``part, doc_id, start, n, ids``: uint16 ids of each whole text and the
    closing id, ``start`` counted within the partition."""
    json_path = json_path or public_path(f"{BYTE_BPE}.json")
    ranks_path = ranks_path or public_path(f"{BYTE_BPE}.tiktoken")
    kind = docs.schema["doc_id"].dataType.simpleString()
    closing = np.array([CLOSING_ID], dtype="<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(json_path, ranks_path)
        part, total = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text"):
            ids = [x + closing for x in bpe.encode_column(b.column("text"))]
            n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
            start = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, dtype=np.int64)), b.column("doc_id"), pa.array(start),
                 pa.array(n), pa.array(ids, pa.binary())], ["part", "doc_id", "start", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        encode, f"part long, doc_id {kind}, start long, n long, ids binary")


def with_offsets(encoded: DataFrame) -> DataFrame:
    """``start`` turned from a place in the partition into one in the stream."""
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    # one row per task of pass one: small at any size of the input
    return (encoded.join(F.broadcast(offsets), "part")
                   .withColumn("start", F.col("start") + F.col("before")).drop("before"))


def cut(placed: DataFrame, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Boundary records: each document's piece in each sequence it touches."""
    kind = placed.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield one(batch.slice(at, 1000))

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows, starts, lengths, crcs, seqs, offs, ids_out = [], [], [], [], [], [], []
        for i, (first, raw) in enumerate(zip(b.column("start").to_pylist(), b.column("ids").to_pylist())):
            ids = np.frombuffer(raw, dtype="<u2")
            wide = memoryview(ids.astype("<u4").tobytes())
            done = 0
            while done < len(ids):
                offset = (first + done) % sequence
                length = min(sequence - offset, len(ids) - done)
                rows.append(i)
                starts.append(done)
                lengths.append(length)
                crcs.append(zlib.crc32(wide[4 * done:4 * (done + length)]))
                seqs.append((first + done) // sequence)
                offs.append(offset)
                if with_ids:
                    ids_out.append(ids[done:done + length].astype(np.int32))
                done += length
        take = pa.array(rows, pa.int64())
        cols = [b.column("doc_id").take(take), *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs)],
                b.column("n").take(take), pa.array(seqs, pa.int64()), pa.array(offs, pa.int64())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(cols, names)

    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
    return placed.select("doc_id", "start", "n", "ids").mapInArrow(pieces, schema)


def pack(docs: DataFrame, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """All pieces of all documents; the encoded ids are written once."""
    return cut(with_offsets(written(encode_documents(docs), "packing")), sequence, with_ids)


def sequences(pieces: DataFrame, sequence: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids`` from pieces with ids.  A short sequence is
    padded to ``sequence`` unless its length is a power of two.  A group holds
    at most ``sequence`` ids, whatever the input."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    got = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    power = F.expr("size(ids) & (size(ids) - 1)") == 0
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.when(power, 0).otherwise(sequence - n)))
    return got.select("sequence_id", n.cast("long").alias("n_tokens"), padded.alias("ids"))
