"""BPE encoding and decoding through a distinct-word table.

Words are split at ASCII white space; nothing in the vocabulary's normaliser,
added tokens or pre-tokeniser reaches across it, so a text's ids are its
words' ids in order.  Documents form blocks of bounded text size.  Each block
sends its distinct words, bucketed by hash; all blocks' copies of a word meet
in one partition, where the word is encoded once.  The ids return to the
block and are joined back by position.  Hot words cost one entry per block,
never one per occurrence, and no task holds more than a block or a bucket.

Decoding joins ids to the vocabulary's pieces (a table whose size is that of
the vocabulary): ``decode_ids`` as a DataFrame join, and the same join as an
Arrow ``take`` inside ``encode_decode``.

Edge cases: null and empty texts have no ids and decode to the empty text;
null ids get a row; repeated rows get a row each; an empty table gives no
rows; other columns are ignored; words of any length are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlens.llm.bytebpe import public_path
from meterlens.llm.util import as_text, pack_bytes, slices, split_words, unpack_bytes, word_hash

WORD_BPE = "word_bpe_49k.json"
#: Text bytes of a block (or one document).
BLOCK_BYTES = 16 << 20
#: Words a task remembers before it starts anew (it would then encode some twice).
CACHE_WORDS = 1_000_000


class WordBpe:
    """The vocabulary file's encoder and its id-to-piece table, as Arrow arrays."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(True))]
        self.pieces = pa.array([f"{p} ".encode() for p in pieces], pa.binary())
        self.numbers = pa.array([b"%d " % i for i in range(len(pieces))], pa.binary())

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many each word has)."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        got = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        ids = [e.ids for e in got]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int32, int(n.sum())), n


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per Spark task
    return WordBpe(path)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Number the blocks of a partition; the same scan gives the same blocks."""
    part = TaskContext.get().partitionId()
    for i, b in enumerate(slices(batches, "text", BLOCK_BYTES)):
        yield (part << 32) | i, b


def block_words(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, block, words``: the distinct words of each block by hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, b in blocks(batches):
            words = split_words(b.column("text"))[2]
            bucket = (word_hash(words) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            words = words.take(pa.array(order))
            full, first = np.unique(bucket[order], return_index=True)
            ends = [*first[1:].tolist(), len(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                 pa.array([pack_bytes(words.slice(x, z - x)) for x, z in zip(first.tolist(), ends)], pa.binary())],
                ["bucket", "block", "words"])

    return docs.select("text").mapInArrow(split, "bucket int, block long, words binary")


def encode_words(words: DataFrame, path: str, buckets: int) -> DataFrame:
    """Each distinct word encoded once, in the one partition that its bucket is in."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        known: dict[bytes, bytes] = {}
        for b in batches:
            for block, packed in zip(b.column("block").to_pylist(), b.column("words").to_pylist()):
                if len(known) > CACHE_WORDS:
                    known.clear()
                mine = unpack_bytes(packed).to_pylist()
                new = [w for w in mine if w not in known]
                ids, n = bpe.encode(new)
                raw, ends = ids.astype("<u2").tobytes(), (2 * np.cumsum(n)).tolist()
                for w, x, z in zip(new, [0] + ends, ends):
                    known[w] = raw[x:z]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([packed], pa.binary()),
                     pa.array([pack_bytes(pa.array([known[w] for w in mine], pa.binary()))], pa.binary())],
                    ["block", "words", "ids"])

    return (words.repartition(buckets, "bucket")
                 .mapInArrow(encode, "block long, words binary, ids binary"))


def block_texts(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=3)
        for block, b in blocks(batches):
            texts = as_text(b.column("text"))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("t", texts.type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([texts], ["t"]))
            ids = b.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()),
                                                                       pa.concat_arrays([ids])),
                 pa.array([zstd.compress(sink.getvalue())], pa.binary())], ["block", "doc_ids", "texts"])

    return docs.select("doc_id", "text").mapInArrow(ship, f"block long, doc_ids array<{kind}>, texts binary")


def _per_word(values: pa.Array, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The concatenated ``values`` of each word's ids."""
    got = values.take(pa.array(ids))
    _, offsets, data = got.buffers()
    at = np.frombuffer(offsets, np.int32)[: len(ids) + 1][starts]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(at.astype(np.int32)), data])


def _per_text(words: pa.Array, at: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The concatenated values of each text's words, each with its last space."""
    _, offsets, data = words.take(pa.array(at)).buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(at) + 1][starts]
    return pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data])


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per document; ``ids`` are decimal,
    joined by one space, ``decoded`` is the vocabulary's decoding of them."""
    path = path or public_path(WORD_BPE)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType

    def join(texts: pa.Table, encoded: pa.Table) -> pa.Table:
        bpe = word_bpe(path)
        none = pa.array([], pa.binary())
        words = pa.concat_arrays([none, *map(unpack_bytes, encoded.column("words").to_pylist())])
        codes = pa.concat_arrays([none, *map(unpack_bytes, encoded.column("ids").to_pylist())])
        ids = np.frombuffer(codes.buffers()[2] or b"", "<u2").astype(np.int32)
        sizes = pc.binary_length(codes).to_numpy().astype(np.int64) // 2
        out = []
        for row in range(texts.num_rows):
            doc_ids = texts.column("doc_ids")[row].values
            text = pa.ipc.open_stream(zstandard.decompress(texts.column("texts")[row].as_py())).read_all().column("t")
            starts, at, mine = split_words(text.combine_chunks())
            place = pc.fill_null(pc.index_in(mine, value_set=words), -1).to_numpy().astype(np.int64)
            lost = np.flatnonzero(place < 0)  # only if the blocks were cut differently: encode here
            extra, n = bpe.encode(mine.take(pa.array(lost)).to_pylist())
            place[lost] = len(words) + np.arange(len(lost))
            all_ids, all_n = np.concatenate([ids[: int(sizes.sum())], extra]), np.concatenate([sizes, n])
            first = np.concatenate([[0], np.cumsum(all_n)])
            at = place[at]
            count = np.concatenate([[0], np.cumsum(all_n[at])])[starts]
            out.append(pa.table([
                pa.chunked_array([doc_ids]), pa.array(np.diff(count)),
                _per_text(_per_word(bpe.numbers, all_ids, first), at, starts),
                _per_text(_per_word(bpe.pieces, all_ids, first), at, starts)],
                names=["doc_id", "n_tokens", "ids", "decoded"]))
        return pa.concat_tables(out) if out else empty

    schema = f"doc_id {kind.simpleString()}, n_tokens long, ids string, decoded string"
    from pyspark.sql.pandas.types import to_arrow_type
    empty = pa.table({"doc_id": pa.array([], to_arrow_type(kind)), "n_tokens": pa.array([], pa.int64()),
                      "ids": pa.array([], pa.string()), "decoded": pa.array([], pa.string())})
    encoded = encode_words(block_words(docs, buckets), path, buckets)
    rows = (block_texts(docs).groupBy("block").cogroup(encoded.groupBy("block"))
            .applyInArrow(join, schema))
    # numbers and pieces hold no space, so this takes off the one after the last
    return rows.withColumns({c: F.rtrim(c) for c in ("ids", "decoded")})


def digests(rows: DataFrame) -> DataFrame:
    """The contract's columns from ``encode_decode`` rows."""
    return rows.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def decode_ids(rows: DataFrame, spark_pieces: DataFrame) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids array<int>`` (one row per id of a
    document) through a join with ``id, piece``; the pieces are as many as the
    vocabulary has, so they are broadcast.  An id without a piece is an empty one."""
    one = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "ids")
    at = one.select("doc_id", "row", F.posexplode_outer("ids").alias("pos", "id"))
    got = at.join(F.broadcast(spark_pieces), "id", "left")
    piece = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("piece", F.lit("")).alias("piece")))
    parts = F.array_sort(F.collect_list(piece))
    return (got.groupBy("row").agg(F.first("doc_id").alias("doc_id"),
                                   F.array_join(F.transform(parts, lambda x: x["piece"]), " ").alias("decoded"))
               .drop("row"))


def pieces(spark, path: str | None = None) -> DataFrame:
    """The vocabulary as ``id, piece`` rows."""
    t = Tokenizer.from_file(path or public_path(WORD_BPE))
    return spark.createDataFrame(sorted((i, p) for p, i in t.get_vocab(True).items()), "id int, piece string")
