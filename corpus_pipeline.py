"""A training-corpus pipeline over ``documents``: quality rules, toxicity,
near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's documents.  All stages
but the last return the columns of ``documents``.  Rejected documents are
gone for good; nothing is sampled.  Null texts count as empty (and fail the
base quality rules); rows without an id are kept by the near-duplicate stage
as they are; repeated rows pass or fail alike.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlens.config import checkpoint_dir
from meterlens.llm import jaccard, packing, pii, quality, toxicity
from meterlens.llm.queries import workers_can_import
from meterlens.llm.util import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the rules reject go."""
    workers_can_import(spark)
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents predicted toxic go."""
    workers_can_import(spark)
    return toxicity.keep_ordinary(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group stays (five-word shingles,
    similarity 0.8 or more)."""
    workers_can_import(spark)
    return jaccard.keep_one(docs, k=5, num=4, den=5)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every span found is replaced by its kind."""
    workers_can_import(spark)
    return pii.redact(docs, pii.fit_pii(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: pieces of 2048-token sequences, with their ids."""
    workers_can_import(spark)
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The stages' models and tokenizers can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between is written below the
    cluster's checkpoint folder."""
    base = os.path.join(checkpoint_dir(spark), f"meterlens-pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{base}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


pipeline = run
