"""Catalog and file operations: database, zone tables, partitions, exports.

Without a Hive metastore Spark refuses ``CREATE EXTERNAL TABLE ... STORED
AS``; ``CREATE TABLE ... USING parquet ... LOCATION`` gives the same
external, partitioned table.  A directory written by a *streaming* file sink
is served as a path read + view instead (its ``_spark_metadata`` log is what
makes it exactly-once, and a table over it cannot recover partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.plans.writes import FILES_PER_PARTITION, cluster_for_write
from meterlens.schema import (
    ALERT_PARTITIONS, PROCESSED_PARTITIONS, PROCESSED_ZONE_SCHEMA, RAW_PARTITIONS,
    RAW_ZONE_SCHEMA, ddl,
)
from meterlens.sources.manifest import EPOCH, follows_manifest, manifest_of, read_published

ZONE_TABLES = {
    "raw_readings": (RAW_ZONE_SCHEMA, RAW_PARTITIONS),
    "meter_features": (PROCESSED_ZONE_SCHEMA, PROCESSED_PARTITIONS),
    "fraud_alerts": (PROCESSED_ZONE_SCHEMA, ALERT_PARTITIONS),
}


def _q(s: str) -> str:
    return s.replace("'", "\\'")


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    comment: str = "Smart-meter readings, features and alerts") -> None:
    loc = f" LOCATION '{_q(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{_q(comment)}'{loc}")


def register_zone_table(spark: SparkSession, db: str, table: str, path: str,
                        recover: bool = True) -> None:
    """External partitioned Parquet table over a batch-written zone."""
    schema, parts = ZONE_TABLES[table]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({ddl(schema, parts)}) USING parquet "
        f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{_q(path)}'")
    if recover:
        recover_partitions(spark, f"{db}.{table}")


def is_stream_sink(spark: SparkSession, path: str) -> bool:
    """True when ``path`` was written by a streaming file sink (has a commit log)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_spark_metadata")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def register_stream_zone_view(spark: SparkSession, db: str, table: str, path: str) -> None:
    """Persistent view over a streaming-sink zone.

    A path read honours the sink's ``_spark_metadata`` log, so readers see
    committed micro-batches only; a catalog table would list every file,
    including those of a failed, replayed batch.  Columns are cast to the
    declared zone types (partition inference would make ``date`` a DATE).
    """
    schema, _ = ZONE_TABLES[table]
    cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{table}` AS "
              f"SELECT {cols} FROM parquet.`{path}`")


def register_manifest_zone_view(spark: SparkSession, db: str, table: str, path: str) -> None:
    """Persistent view over a zone that follows a manifest: the folders of
    published attempts, listed anew by every query."""
    schema, _ = ZONE_TABLES[table]
    cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{table}` AS SELECT {cols} FROM parquet.`{path}` "
              f"WHERE `{EPOCH}` IN (SELECT substring_index(path, '@', -1) FROM binaryFile.`{manifest_of(path)}`)")


def register_zone(spark: SparkSession, db: str, table: str, path: str) -> None:
    """Table for a batch-written zone, view for one written by streams."""
    if follows_manifest(spark, path):
        register_manifest_zone_view(spark, db, table, path)
    elif is_stream_sink(spark, path):
        register_stream_zone_view(spark, db, table, path)
    else:
        register_zone_table(spark, db, table, path)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """``MSCK REPAIR TABLE``: add partition directories written since."""
    spark.catalog.recoverPartitions(table)


def read_zone(spark: SparkSession, path: str, table: str = "meter_features") -> DataFrame:
    """Path read with the declared schema (else ``date`` is inferred as DATE)."""
    schema, _ = ZONE_TABLES[table]
    if follows_manifest(spark, path):
        return read_published(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def register_zone_view(spark: SparkSession, name: str, path: str,
                       table: str = "meter_features") -> DataFrame:
    df = read_zone(spark, path, table)
    df.createOrReplaceTempView(name)
    return df


def scope(df: DataFrame, date_from: str | None = None, date_to: str | None = None,
          meters=None) -> DataFrame:
    """Restrict any zone frame to a date range and/or meters.

    On a zone read from its partitioned layout the predicates become
    ``PartitionFilters``: directories outside the range are never listed or
    read.  Apply it before any operator; the operators stay unchanged.
    """
    if date_from:
        df = df.filter(F.col("date") >= date_from)
    if date_to:
        df = df.filter(F.col("date") <= date_to)
    if meters is not None:
        df = df.filter(F.col("meter_id").isin(list(meters)))
    return df


def show_tables(spark: SparkSession, db: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{db}`")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {table}")


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """SQL text -> DataFrame (lazy; the caller decides how to consume it)."""
    return spark.sql(sql)


def copy_zone_orc(df: DataFrame, path: str, partitions=PROCESSED_PARTITIONS,
                  mode: str = "overwrite", files_per_partition: int = FILES_PER_PARTITION) -> None:
    """ORC copy of a zone, same partition layout, at most ``files_per_partition``
    files a directory."""
    cluster_for_write(df, partitions, files_per_partition).write.mode(mode).format("orc").partitionBy(*partitions).save(path)


def export_summary_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, written in parallel (one file per task, no index)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_zone(df: DataFrame, path: str, table: str, mode: str = "append",
               files_per_partition: int = FILES_PER_PARTITION) -> None:
    """Batch write of a zone with its partition layout, at most
    ``files_per_partition`` new files a directory."""
    _, parts = ZONE_TABLES[table]
    cluster_for_write(df, parts, files_per_partition).write.mode(mode).partitionBy(*parts).parquet(path)


__all__ = ["scope", "create_database", "register_zone_table", "register_zone",
           "register_manifest_zone_view", "register_stream_zone_view", "is_stream_sink", "recover_partitions", "read_zone",
           "register_zone_view", "show_tables", "describe_table", "run_query", "copy_zone_orc",
           "export_summary_csv", "write_zone", "ZONE_TABLES"]
