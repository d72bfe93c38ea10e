"""Database, external zone tables, partition recovery, exports."""

import os

from meterlens.queries import meter_features
from meterlens.sources.catalog import (
    copy_zone_orc, create_database, describe_table, export_summary_csv, read_zone,
    register_zone_table, show_tables, write_zone,
)
from meterlens.operators.summary import report_summary
from tests.conftest import SF001


def test_zone_tables_roundtrip(spark, scratch):
    mf = meter_features(spark, SF001)
    zone = os.path.join(scratch, "processed")
    write_zone(mf.drop("event_id"), zone, "meter_features")
    create_database(spark, "meters_t", os.path.join(scratch, "db"))
    register_zone_table(spark, "meters_t", "meter_features", zone)
    assert spark.table("meters_t.meter_features").count() == 1000
    names = [r.tableName for r in show_tables(spark, "meters_t").collect()]
    assert "meter_features" in names
    assert describe_table(spark, "meters_t.meter_features").count() > 10
    # new partitions appear after recovery
    more = mf.drop("event_id").limit(10).selectExpr("*").drop("date").selectExpr("*", "'2030-01-01' AS date")
    write_zone(more.select(*mf.drop("event_id").columns), zone, "meter_features")
    spark.catalog.recoverPartitions("meters_t.meter_features")
    assert spark.table("meters_t.meter_features").count() == 1010
    assert read_zone(spark, zone, "meter_features").schema["date"].dataType.simpleString() == "string"


def test_orc_copy_and_csv(spark, scratch):
    mf = meter_features(spark, SF001).drop("event_id")
    copy_zone_orc(mf, os.path.join(scratch, "orc"))
    assert spark.read.orc(os.path.join(scratch, "orc")).count() == 1000
    export_summary_csv(report_summary(mf), os.path.join(scratch, "csv"))
    df = spark.read.option("header", True).csv(os.path.join(scratch, "csv"))
    assert df.count() == 10 and "fraud_rate_pct" in df.columns


def test_scope_prunes_partitions(spark, scratch):
    from meterlens.operators.overview import q1_1_daily_overview
    from meterlens.sources.catalog import scope
    zone = os.path.join(scratch, "zone")
    write_zone(meter_features(spark, SF001).drop("event_id"), zone, "meter_features")
    df = scope(read_zone(spark, zone, "meter_features"), "2024-01-10", "2024-01-12", ["MTR_001"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = q1_1_daily_overview(df)._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "2024-01-10" in part and "2024-01-12" in part and "MTR_001" in part
    got = {r.date for r in q1_1_daily_overview(df).collect()}
    assert got <= {"2024-01-10", "2024-01-11", "2024-01-12"} and got


def test_stream_zone_view_reads_committed_files_only(spark, scratch):
    from pyspark.sql import functions as F

    from meterlens.schema import KAFKA_SCHEMA
    from meterlens.sources.catalog import is_stream_sink, register_zone
    from meterlens.sources.events import kafka_records
    from meterlens.streaming.zones import ZonePaths, run_pipeline

    src = os.path.join(scratch, "src")
    kafka_records(spark, SF001).coalesce(1).write.parquet(os.path.join(src, "p0"))
    paths = ZonePaths(os.path.join(scratch, "raw"), os.path.join(scratch, "processed"),
                      os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"))
    stream = spark.readStream.schema(KAFKA_SCHEMA).parquet(os.path.join(src, "*"))
    for q in run_pipeline(stream, paths, trigger="availableNow", console=False):
        q.awaitTermination()
    # a stray file, as a failed and replayed micro-batch could leave behind
    day = sorted(d for d in os.listdir(paths.raw) if d.startswith("date="))[0]
    meter = sorted(os.listdir(os.path.join(paths.raw, day)))[0]
    stray = read_zone(spark, paths.raw, "raw_readings").limit(5).drop("date", "meter_id")
    stray.coalesce(1).write.mode("append").parquet(os.path.join(paths.raw, day, meter))
    assert is_stream_sink(spark, paths.raw)
    create_database(spark, "meters_sv", os.path.join(scratch, "db"))
    register_zone(spark, "meters_sv", "raw_readings", paths.raw)
    assert spark.table("meters_sv.raw_readings").count() == 1000
    # a listing read that ignores the commit log would see the stray rows
    listed = spark.read.option("basePath", paths.raw).parquet(os.path.join(paths.raw, "date=*", "meter_id=*"))
    assert listed.agg(F.count("*")).first()[0] == 1005
