"""Answers follow the data of the moment; strict decoding; session-zone independence."""

import json
import os

import pytest
from pyspark.sql import functions as F

from meterlens.functions.rules import score_live
from meterlens.operators import baseline, outliers, summary
from meterlens.queries import QUERIES, meter_features
from meterlens.sources import kafka
from tests.conftest import SF001

READING = "meter_id string, timestamp string, consumption_kwh double, week_of_year int"


def readings(spark, path):
    return spark.read.schema(READING).parquet(path)


@pytest.mark.parametrize("op", [outliers.q4_1_zscore, outliers.q4_2_iqr, baseline.weekly_expected_range])
def test_second_call_sees_appended_files(spark, scratch, op):
    path = os.path.join(scratch, "zone")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    first = [("m", f"t{i:03d}", 1.0 + i % 3, 1) for i in range(20)]
    spark.createDataFrame(first, READING).write.parquet(path)
    assert op(readings(spark, path)).count() == 0
    more = [("m", f"u{i:03d}", 100.0 + i % 3, 1) for i in range(200)]
    spark.createDataFrame(more, READING).write.mode("append").parquet(path)
    again = [tuple(r) for r in op(readings(spark, path)).collect()]
    spark.createDataFrame(first + more, READING).createOrReplaceTempView("all_readings")
    assert again == [tuple(r) for r in op(spark.table("all_readings")).collect()]
    assert len(again) <= 20
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_latest_messages_second_call(spark, scratch):
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    path = os.path.join(scratch, "topic")
    one = lambda lo, hi: spark.range(lo, hi).selectExpr(
        "cast('k' as binary) key", "cast('{}' as binary) value", "'t' topic", "0 partition", "id offset",
        "timestamp_seconds(id) timestamp")
    one(0, 50).write.parquet(path)
    read = lambda: {r.offset for r in kafka.latest_messages(spark.read.schema(schema).parquet(path), 10).collect()}
    assert read() == set(range(40, 50))
    one(50, 90).write.mode("append").parquet(path)
    assert read() == set(range(80, 90))


BAD = [b'{"meter_id":"x"} junk', b'{"meter_id":"x"}{"meter_id":"y"}', b"{'meter_id':'x'}", b'[{"meter_id":"x"}]', b"null",
       b"", b"3", b'"s"', b"\xef\xbb\xbf{}", b'{"meter_id":"x"}}', b'{"meter_id":"x"}],[', b'{"a":1},"b":2', b"{", b"{} {}",
       b'{"meter_id":"x",}', b'{"a":01}', b'{"a":+1}', b"{a:1}", b"\xff{}", b'{"meter_id":"x"}} ,{"z":{']
GOOD = [b'{"meter_id":"x"}', b' {"meter_id" : "x"}\n', b"{}", b'{"consumption_kwh":NaN}', b'{"consumption_kwh":[1]}', b'{"other":{"a":[1,{}]}}']


def test_decode_agrees_with_json(spark):
    rows = [(b"k", v, "t", 0, i, None) for i, v in enumerate(BAD + GOOD)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")

    def ok(v):
        try:
            return isinstance(json.loads(v.decode()), dict)
        except ValueError:
            return False
    assert {r.offset for r in kafka.decode_valid(df).collect()} == {i for i, v in enumerate(BAD + GOOD) if ok(v)}


def test_starting_offsets():
    got = json.loads(kafka.starting_offsets({0: 0, 1: 95, 2: 0}, {0: 100, 1: 100, 2: 3}, "t", 30))
    assert got == {"t": {"0": 89, "1": 95, "2": 0}}


def test_live_scoring_ignores_session_zone_and_suffixes(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00", "3.5d"), ("2024-01-15T10:00:00+02:00", "3.5"), ("bad", "1e2"),
                                ("2024-01-15T10:00:00Z", " 2 "), ("2024-01-15", "0x1p3")], "timestamp string, consumption_kwh string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = []
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.append([(None if r.event_time is None else str(r.event_time), r.consumption_kwh) for r in score_live(df).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert seen[0] == seen[1] == [("2024-01-15 10:00:00", None), ("2024-01-15 08:00:00", 3.5), (None, 100.0),
                                  ("2024-01-15 10:00:00", 2.0), ("2024-01-15 00:00:00", None)]


def test_no_sort_aggregate_and_sixty_meters(spark):
    for name in ("q1_2_meter_overview", "q5_1_suspicious_meters"):
        assert "SortAggregate" not in QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    mf = meter_features(spark, SF001).withColumn("meter_id", F.concat(F.lit("M"), F.col("event_id") % 60))
    assert summary.meter_table(summary.report_summary(mf)).select("meter_id").distinct().count() == 60
