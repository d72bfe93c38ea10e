"""A commit log over several zones written together.

Every attempt to write a micro-batch puts its rows of all zones below
``_epoch=<attempt>`` folders, the innermost partition level of each zone.  One file
of a single byte in the manifest folder, closed after all zones are written, makes
the attempt's rows of all zones visible at once (an empty one counts for nothing);
readers keep only the folders of published attempts, as partition pruning.
Whatever a lost driver or a failed attempt left behind is never read.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: The partition column that names an attempt; the manifest's folder beside the zones.
EPOCH = "_epoch"
FOLDER = "_manifest"


def manifest_of(zone: str) -> str:
    """The manifest that the zones of one parent folder share."""
    return os.path.join(os.path.dirname(zone.rstrip("/")), FOLDER)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def published(spark: SparkSession, manifest: str) -> dict[str, str]:
    """Attempt of every published epoch; one small file an epoch, listed, not read."""
    fs, p = _fs(spark, manifest)
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.getLen()]
    return dict(n.split("@", 1) for n in names if "@" in n)


def follows_manifest(spark: SparkSession, zone: str) -> bool:
    """Whether the zone is written through a manifest (also before its first commit)."""
    fs, mark = _fs(spark, os.path.join(manifest_of(zone), os.path.basename(zone.rstrip("/")) + ".zone"))
    return fs.exists(mark)


def open_manifest(spark: SparkSession, manifest: str, zones: list[str]) -> None:
    """Say once which zones the manifest rules."""
    for zone in zones:
        fs, p = _fs(spark, os.path.join(manifest, os.path.basename(zone.rstrip("/")) + ".zone"))
        if not fs.exists(p):
            fs.create(p, True).close()


def new_attempt(epoch: str) -> str:
    return f"{epoch}.{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, manifest: str, epoch: str, attempt: str) -> None:
    """Make an attempt's rows visible in all zones at once."""
    fs, p = _fs(spark, os.path.join(manifest, f"{epoch}@{attempt}"))
    out = fs.create(p, False)
    out.writeBytes("1")
    out.close()


def read_published(spark: SparkSession, zone: str, schema: StructType) -> DataFrame:
    """The zone's rows of published attempts."""
    attempts = list(published(spark, manifest_of(zone)).values())
    if not attempts:
        return spark.createDataFrame([], schema)
    wide = StructType([*schema.fields, StructField(EPOCH, StringType())])
    return spark.read.schema(wide).parquet(zone).filter(F.col(EPOCH).isin(attempts)).drop(EPOCH)


def drop_unpublished(spark: SparkSession, zone: str) -> int:
    """Remove folders of attempts that were never published; only while no
    writer runs.  Returns how many."""
    known = set(published(spark, manifest_of(zone)).values())
    fs, _ = _fs(spark, zone)
    gone = 0
    for above in ("*", "*/*"):  # zones have one or two partition levels above
        for s in fs.globStatus(_fs(spark, f"{zone.rstrip('/')}/{above}/{EPOCH}=*")[1]) or []:
            if s.getPath().getName().split("=", 1)[1] not in known:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone
