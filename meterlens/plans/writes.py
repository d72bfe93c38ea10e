"""Clustered writes of partitioned zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files a partition directory gets at most, unless told otherwise: per batch
#: write, and per micro-batch (whose size the source's options bound).
FILES_PER_PARTITION = 4
FILES_PER_BATCH = 1


def cluster_for_write(df: DataFrame, parts, files_per_partition: int = FILES_PER_PARTITION) -> DataFrame:
    """Shuffle rows so each partition directory is written by at most
    ``files_per_partition`` tasks.  A deterministic hash salt spreads a hot
    (date, meter) directory over several tasks and keeps retries stable."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in parts], salt)
