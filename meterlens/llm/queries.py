"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table
and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm import bpe, jaccard, langid, licenses, lm, merkle, packing, pii, quality, topk, toxicity, trie, urlfilter
from meterlens.llm.util import table

Query = Callable[[SparkSession, str], DataFrame]
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers that share this folder import the package, also when
    the driver was started elsewhere; a cluster that has it installed needs none."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (env.get("PYTHONPATH", ""), ROOT) if p)


def _query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_can_import(spark)
        return f(spark, sf_dir)
    return run


def _bpe(spark, sf):
    return bpe.digests(bpe.encode_decode(table(spark, sf, "documents")))


def _pii(spark, sf):
    docs = table(spark, sf, "documents")
    return pii.digests(pii.find_pii(docs, pii.fit_pii(docs)))


def _packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


def _toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit_toxicity(docs, labels, toxicity.in_training(F.col("doc_id")))
    return toxicity.score_toxicity(docs, model)


def _quality(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.judge_quality(docs, quality.fit_quality(docs, table(spark, sf, "labels")))


def _jaccard(spark, sf):
    return jaccard.similar_documents(table(spark, sf, "documents"), k=4, num=85, den=100)


def _urls(spark, sf):
    return urlfilter.judge_urls(table(spark, sf, "pages"), urlfilter.rule_table(spark))


def _topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % topk.EVERY == 0))


def _langid(spark, sf):
    langs, logp = langid.count_trigrams(table(spark, sf, "documents"))
    return langid.identify(langid.page_evidence(table(spark, sf, "pages")), langs, logp)


def _lm(spark, sf):
    return lm.score_texts(table(spark, sf, "documents"))


def _licenses(spark, sf):
    return licenses.report(licenses.scan_licenses(table(spark, sf, "documents")))


def _merkle(spark, sf):
    return merkle.proofs(merkle.build_manifest(table(spark, sf, "documents")))


def _trie(spark, sf):
    return trie.build_trie(table(spark, sf, "conversations")).select(*trie.CONTRACT)


QUERIES: dict[str, Query] = {name: _query(f) for name, f in {
    "op1_bpe": _bpe,
    "op2_pii": _pii,
    "op3_langid": _langid,
    "op4_packing": _packing,
    "op5_toxicity": _toxicity,
    "op6_urlfilter": _urls,
    "op7_lm": _lm,
    "op8_quality": _quality,
    "op9_jaccard": _jaccard,
    "op10_topk": _topk,
    "op11_licenses": _licenses,
    "op12_merkle": _merkle,
    "op13_trie": _trie,
}.items()}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op6_urlfilter": urlfilter.ORACLE,
    "op10_topk": topk.ORACLE,
    "op11_licenses": licenses.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_trie": trie.ORACLE,
}
