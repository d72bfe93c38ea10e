"""End-to-end: stream Kafka-shaped files to zones, then report from them."""

import os

from pyspark.sql import functions as F

from meterlens import cli
from meterlens.sources.events import kafka_records
from tests.conftest import SF001


def test_stream_then_report(spark, scratch, capsys):
    src = os.path.join(scratch, "src")
    kafka_records(spark, SF001).coalesce(2).write.parquet(os.path.join(src, "p0"))
    base = os.path.join(scratch, "zones")
    cli.main(["stream", "--source-dir", os.path.join(src, "*"), "--base", base, "--once",
              "--no-console"])
    cli.main(["register", "--db", "meters_cli", "--base", base])
    assert spark.table("meters_cli.meter_features").count() == 1000
    assert spark.table("meters_cli.raw_readings").schema["date"].dataType.simpleString() == "string"
    out = os.path.join(scratch, "report")
    cli.main(["report", "--zone", os.path.join(base, "processed"), "--out", out])
    printed = capsys.readouterr().out
    assert '"total_readings": 1000' in printed
    csv = spark.read.option("header", True).csv(os.path.join(out, "fraud_summary"))
    assert csv.agg(F.sum(F.col("total_readings").cast("long"))).first()[0] == 1000
