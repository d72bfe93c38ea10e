"""Raw / processed / alert zones as partitioned Parquet, written by streams.

The file sink keeps a commit log (``_spark_metadata``) next to the data and
the query keeps its offsets in the checkpoint, so a restarted query neither
loses nor duplicates rows.  Checkpoints live under the cluster's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from meterlens.config import TRIGGER_INTERVAL, WATERMARK_DELAY, checkpoint_dir
from meterlens.functions.features import add_features
from meterlens.functions.rules import apply_rules
from meterlens.operators.alerts import ALERT_FEED_COLUMNS
from meterlens.plans.writes import FILES_PER_BATCH, cluster_for_write
from meterlens.schema import ALERT_PARTITIONS, PROCESSED_PARTITIONS, RAW_PARTITIONS
from meterlens.sources.kafka import parse_readings
from meterlens.sources.manifest import EPOCH, manifest_of, new_attempt, open_manifest, publish, published


@dataclass(frozen=True)
class ZonePaths:
    raw: str
    processed: str
    alerts: str
    checkpoints: str

    @classmethod
    def under(cls, spark: SparkSession, base: str, name: str = "energy") -> "ZonePaths":
        """Zones below ``base``; checkpoints below the shared checkpoint dir."""
        ck = os.path.join(checkpoint_dir(spark), "streams", name)
        return cls(os.path.join(base, "raw"), os.path.join(base, "processed"),
                   os.path.join(base, "alerts"), ck)

    @property
    def manifest(self) -> str:
        return manifest_of(self.raw)

    def checkpoint(self, query: str) -> str:
        return os.path.join(self.checkpoints, query)


def stream_ready(df: DataFrame, col: str = "event_time") -> DataFrame:
    """Make the event time a ``timestamp`` (watermarks refuse ``timestamp_ntz``);
    an NTZ value is read as UTC wall clock."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(col))
        return df.withColumn(col, local.cast("timestamp"))
    return df


def _trigger(w, trigger):
    if trigger is None:
        return w
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger)


def _write_parquet(df: DataFrame, path: str, checkpoint: str, partitions, trigger, name: str,
                   files_per_partition: int | None = FILES_PER_BATCH):
    if files_per_partition:
        df = cluster_for_write(df, partitions, files_per_partition)
    w = (df.writeStream.outputMode("append").format("parquet")
           .option("path", path).option("checkpointLocation", checkpoint)
           .partitionBy(*partitions).queryName(name))
    return _trigger(w, trigger).start()


def write_raw(df: DataFrame, paths: ZonePaths, trigger=TRIGGER_INTERVAL,
              files_per_partition: int | None = FILES_PER_BATCH) -> StreamingQuery:
    """Decoded, un-enriched readings, partitioned by date and meter."""
    return _write_parquet(df, paths.raw, paths.checkpoint("raw"), RAW_PARTITIONS, trigger,
                          "zone_raw", files_per_partition)


def write_processed(df: DataFrame, paths: ZonePaths, trigger=TRIGGER_INTERVAL,
                    files_per_partition: int | None = FILES_PER_BATCH) -> StreamingQuery:
    """Enriched and scored readings, partitioned by date and meter."""
    return _write_parquet(df, paths.processed, paths.checkpoint("processed"), PROCESSED_PARTITIONS,
                          trigger, "zone_processed", files_per_partition)


def write_alerts(df: DataFrame, paths: ZonePaths, trigger=TRIGGER_INTERVAL,
                 files_per_partition: int | None = FILES_PER_BATCH) -> StreamingQuery:
    """Flagged readings only, partitioned by date."""
    return _write_parquet(df.filter(F.col("is_fraud_flagged")), paths.alerts,
                          paths.checkpoint("alerts"), ALERT_PARTITIONS, trigger, "zone_alerts",
                          files_per_partition)


def write_alerts_console(df: DataFrame, trigger=TRIGGER_INTERVAL, num_rows: int = 20) -> StreamingQuery:
    """Mirror flagged rows (ten columns) to the driver console."""
    w = (df.filter(F.col("is_fraud_flagged")).select(*ALERT_FEED_COLUMNS)
           .writeStream.outputMode("append").format("console")
           .option("truncate", False).option("numRows", num_rows).queryName("alerts_console"))
    return _trigger(w, trigger).start()


def score_stream(kafka: DataFrame, watermark: str = WATERMARK_DELAY):
    """(raw, scored) streams from Kafka-shaped input."""
    raw = parse_readings(kafka, watermark)
    return raw, apply_rules(add_features(raw))


def run_pipeline(kafka: DataFrame, paths: ZonePaths, trigger=TRIGGER_INTERVAL,
                 console: bool = True, await_any: bool = False,
                 files_per_partition: int | None = FILES_PER_BATCH) -> list[StreamingQuery]:
    """The reference job: decode -> features -> rules -> three zone sinks
    (+ console mirror), each its own query reading the source itself.

    ``files_per_partition`` shuffles each micro-batch by the partition
    columns (plus a hash salt) so a directory receives at most that many
    files per batch instead of one per input task.
    """
    raw, scored = score_stream(kafka)
    fpp = files_per_partition
    qs = [write_raw(raw, paths, trigger, fpp), write_processed(scored, paths, trigger, fpp),
          write_alerts(scored, paths, trigger, fpp)]
    if console:
        qs.append(write_alerts_console(scored, trigger))
    if await_any:
        kafka.sparkSession.streams.awaitAnyTermination()
    return qs


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's lasting id, from its checkpoint: epochs count anew with a new one."""
    lines = spark.read.text(os.path.join(checkpoint, "metadata")).collect()  # one line
    return json.loads(lines[0][0])["id"]


def write_epoch(batch: DataFrame, epoch: str, paths: ZonePaths,
                files_per_partition: int | None = FILES_PER_BATCH) -> bool:
    """Write one micro-batch to all zones and publish them together.

    False if the epoch was published before.  The batch is decoded once and
    clustered once by (date, meter), with a salt of the Kafka position where
    a directory may get several files; raw and processed rows are written
    from that layout, and only the flagged rows move again, by date.
    """
    spark = batch.sparkSession
    if epoch in published(spark, paths.manifest):
        return False
    open_manifest(spark, paths.manifest, [paths.raw, paths.processed, paths.alerts])
    attempt = new_attempt(epoch)
    fpp = files_per_partition
    raw = parse_readings(batch, watermark=None)
    if fpp:
        salt = [F.pmod(F.xxhash64("kafka_key", "kafka_timestamp"), F.lit(fpp))] if fpp > 1 else []
        raw = raw.repartition(*RAW_PARTITIONS, *salt)
    raw = raw.persist()
    scored = apply_rules(add_features(raw))
    flagged = scored.filter(F.col("is_fraud_flagged"))
    if fpp:
        flagged = cluster_for_write(flagged, ALERT_PARTITIONS, fpp)

    def write(df: DataFrame, parts, path: str) -> None:
        (df.withColumn(EPOCH, F.lit(attempt)).write.mode("append").partitionBy(*parts, EPOCH).parquet(path))

    try:
        write(raw, RAW_PARTITIONS, paths.raw)  # fills the cache for the other two, which need not wait for each other
        with ThreadPoolExecutor(max_workers=2) as pool:
            jobs = [pool.submit(write, scored, PROCESSED_PARTITIONS, paths.processed),
                    pool.submit(write, flagged, ALERT_PARTITIONS, paths.alerts)]
            for j in jobs:
                j.result()
    finally:
        raw.unpersist()
    publish(spark, paths.manifest, epoch, attempt)
    return True


def write_zones_batch(kafka: DataFrame, paths: ZonePaths, trigger=TRIGGER_INTERVAL,
                      files_per_partition: int | None = FILES_PER_BATCH) -> StreamingQuery:
    """One query for all zones: each micro-batch is read and decoded once.

    A micro-batch appears in all three zones at once or in none
    (``sources.manifest``): a driver lost at any step leaves folders that no
    reader follows, and the replayed batch is written anew; a batch that was
    published is skipped.  ``read_zone`` follows the manifest.
    ``files_per_partition`` bounds the files a directory gets from a
    micro-batch; None writes as the input is partitioned.
    """
    checkpoint = paths.checkpoint("zones_batch")
    ids: list[str] = []

    def write(batch: DataFrame, epoch: int):
        if not ids:
            ids.append(_query_id(batch.sparkSession, checkpoint))
        write_epoch(batch, f"{ids[0]}-{epoch:010d}", paths, files_per_partition)

    w = (kafka.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint)
              .queryName("zones_batch"))
    return _trigger(w, trigger).start()
