"""Language identification by Bayesian evidence fusion.

Evidence of a row: the text under byte-trigram models of each language, the
language its markup declares, the last label of its host, and its host.
The trigram models are counted over all labelled documents, whole texts.
How reliable declarations are, and which languages a suffix and a host hold,
comes from grouped aggregation over all rows' text verdicts: hosts are
smoothed towards their suffix and suffixes towards the whole, so a host with
few rows says little and one with many says much.  The posterior multiplies
the tempered text likelihood, the declaration's likelihood and the host prior.

Edge cases: null and empty texts leave the other evidence to decide; a
missing declaration, url or host is a value of its own kind and not an error;
null ids get a row; repeated rows get a row each; an empty table gives no
rows; other columns are ignored; without any labelled document the language
and posterior are null.  Ties go to the alphabetically first language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.urlfilter import host_and_path
from meterlens.llm.util import byte_texts, slices, written

BUCKETS = 1 << 14
#: Trigrams after which a text's evidence grows no further (they are not independent).
TEMPER = 60
#: Weight of the coarser level in a finer level's prior, in rows.
SMOOTH = 5.0

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of every byte trigram of the whole text, A-Z lower-cased."""
    b = np.frombuffer(text.translate(_LOWER), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((h * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def count_trigrams(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket in each) over all documents
    with a text and a language.  Only BUCKETS counts a language reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), byte_texts(b.column("text"))):
                if lang not in total:
                    total[lang] = np.zeros(BUCKETS, np.int64)
                total[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(n[at])], ["lang", "bucket", "n"])

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    got = (rows.mapInArrow(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(got.column("lang").to_pylist()))
    n = np.full((BUCKETS, len(langs)), 0.5)
    place = {x: i for i, x in enumerate(langs)}
    n[got.column("bucket").to_numpy(), [place[x] for x in got.column("lang").to_pylist()]] += got.column("n").to_numpy()
    return langs, np.log(n / n.sum(axis=0))


def visible_text(html: Column) -> Column:
    """Markup, scripts, styles and comments taken out, white space made single."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def declared_language(html: Column) -> Column:
    got = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(F.length(got) > 0, got)


def page_evidence(pages: DataFrame) -> DataFrame:
    """``page_id, host, suffix, declared, text`` of ``page_id, url, html``."""
    host = host_and_path(F.col("url"))[0]
    return (pages.select("page_id", host.alias("host"), declared_language(F.col("html")).alias("declared"),
                         visible_text(F.col("html")).alias("text"))
                 .withColumn("suffix", F.element_at(F.split("host", r"\."), -1)))


def identify(rows: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """``page_id, host, suffix, declared, text_lang, lang, posterior`` of evidence rows."""
    kind = rows.schema["page_id"].dataType.simpleString()
    none = F.lit(None).cast("string")
    if not langs:
        return rows.select("page_id", "host", "suffix", "declared", none.alias("text_lang"), none.alias("lang"),
                           F.lit(None).cast("double").alias("posterior"))

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = np.zeros((b.num_rows, len(langs)))
            for i, text in enumerate(byte_texts(b.column("text"))):
                t = trigrams(text)
                if len(t):
                    out[i] = logp[t].sum(axis=0) * min(1.0, TEMPER / len(t))
            out -= out.max(axis=1, keepdims=True) if len(out) else 0
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("page_id", "host", "suffix", "declared")]
                + [pa.array(list(out), pa.list_(pa.float64()))], ["page_id", "host", "suffix", "declared", "ll"])

    seen = written(rows.select("page_id", "host", "suffix", "declared", "text").mapInArrow(
        likelihood, f"page_id {kind}, host string, suffix string, declared string, ll array<double>"), "langid")
    names = F.array(*[F.lit(x) for x in langs])
    # a flat likelihood (no text) votes for nothing
    flat = F.array_min("ll") == F.array_max("ll")
    best = F.when(~flat, F.element_at(names, (F.array_position("ll", F.array_max("ll"))).cast("int")))
    voted = seen.withColumn("text_lang", best)
    votes = lambda *by: voted.groupBy(*by).agg(*[F.count_if(F.col("text_lang") == x).cast("double").alias(x) for x in langs])
    vector = lambda of: F.array(*[F.col(x) for x in langs]).alias(of)
    # whole -> suffix -> host, each smoothed by the coarser one; declarations by language
    whole = votes().first()
    total = sum(whole)
    prior = F.array(*[F.lit((whole[x] + 1) / (total + len(langs))) for x in langs])
    mixed = lambda n, coarse: F.transform(
        F.arrays_zip(n.alias("n"), coarse.alias("c")),
        lambda z: (z["n"] + SMOOTH * z["c"]) / (F.aggregate(n, F.lit(0.0), lambda a, x: a + x) + SMOOTH))
    suffixes = votes("suffix").select("suffix", vector("ns")).select(
        "suffix", mixed(F.col("ns"), prior).alias("by_suffix"))
    hosts = written(votes("host", "suffix").select("host", "suffix", vector("nh")).join(suffixes, "suffix")
                    .select(F.col("host").alias("at_host"), mixed(F.col("nh"), F.col("by_suffix")).alias("prior")),
                    "langid-hosts")
    said = votes(F.coalesce("declared", F.lit("")).alias("said")).select("said", vector("nd"))
    kinds = said.count()
    trust = written(said.select("said", F.transform(
        F.arrays_zip(F.col("nd").alias("n"), F.array(*[F.lit(float(whole[x])) for x in langs]).alias("t")),
        lambda z: (z["n"] + 0.5) / (z["t"] + 0.5 * kinds)).alias("trust")), "langid-declared")
    # both sides are read back, so a host or declaration with very many rows is split by the join
    fused = (voted.withColumn("said", F.coalesce("declared", F.lit(""))).join(trust, "said")
                  .join(hosts, F.col("host") == F.col("at_host")))
    parts = F.arrays_zip(F.col("ll").alias("l"), F.col("trust").alias("t"), F.col("prior").alias("p"))
    log_post = F.transform(parts, lambda z: z["l"] + F.log(z["p"]) + F.when(F.col("declared").isNull(), 0.0).otherwise(F.log(z["t"])))
    top = F.array_max("post")
    return (fused.withColumn("post", log_post).select(
        "page_id", "host", "suffix", "declared", "text_lang",
        F.element_at(names, F.array_position("post", top).cast("int")).alias("lang"),
        (1 / F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("posterior")))
