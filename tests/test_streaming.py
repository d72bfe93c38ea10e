"""Streaming = batch on a Kafka-shaped file source; restart; late data."""

import os

import pytest
from pyspark.sql import functions as F

from meterlens.functions import add_features, apply_rules
from meterlens.operators import live
from meterlens.operators.baseline import rolling_baseline
from meterlens.schema import KAFKA_SCHEMA
from meterlens.sources.catalog import read_zone
from meterlens.sources.events import kafka_records, readings
from meterlens.sources.kafka import parse_readings
from meterlens.streaming.rollups import stream_rollups, stream_timeline
from meterlens.streaming.state import stream_rolling_baseline, stream_rolling_baseline_tws
from meterlens.streaming.zones import ZonePaths, run_pipeline, stream_ready, write_zones_batch
from tests.conftest import SF001


def _stamp(d, i):
    """Give batch ``i``'s files a distinct, increasing modification time so a
    file stream with ``maxFilesPerTrigger`` reads the batches in order."""
    t = 1_700_000_000 + 10 * i
    for root, _, files in os.walk(d):
        for f in files:
            os.utime(os.path.join(root, f), (t, t))


def _write_kafka_files(spark, d, parts, start=0):
    recs = kafka_records(spark, SF001)
    for i, cond in enumerate(parts, start):
        recs.filter(cond).coalesce(1).write.parquet(os.path.join(d, f"part{i}"))
        _stamp(os.path.join(d, f"part{i}"), i)


def _stream(spark, d, **opts):
    r = spark.readStream.schema(KAFKA_SCHEMA)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.parquet(os.path.join(d, "*"))


def _batch_scored(spark):
    return apply_rules(add_features(parse_readings(kafka_records(spark, SF001))))


def test_pipeline_zones_equal_batch_and_restart(spark, scratch):
    src = os.path.join(scratch, "src")
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") < 600])
    paths = ZonePaths(os.path.join(scratch, "raw"), os.path.join(scratch, "processed"),
                      os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"))
    for q in run_pipeline(_stream(spark, src), paths, trigger="availableNow", console=False):
        q.awaitTermination()
    assert read_zone(spark, paths.raw, "raw_readings").count() == 600
    # restart: new data arrives, nothing lost, nothing duplicated
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") >= 600], start=1)
    for q in run_pipeline(_stream(spark, src), paths, trigger="availableNow", console=False):
        q.awaitTermination()
    raw = read_zone(spark, paths.raw, "raw_readings")
    processed = read_zone(spark, paths.processed, "meter_features")
    alerts = read_zone(spark, paths.alerts, "fraud_alerts")
    assert raw.count() == 1000 and raw.select("kafka_key", "timestamp").distinct().count() == 1000
    batch = _batch_scored(spark)
    cols = ["meter_id", "timestamp", "consumption_kwh", "power_ratio", "rules_fired_count",
            "fraud_severity", "is_fraud_flagged"]
    assert processed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(processed.select(cols)).count() == 0
    assert alerts.count() == batch.filter("is_fraud_flagged").count()


def test_foreach_batch_zones(spark, scratch):
    src = os.path.join(scratch, "src")
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") < 500, F.expr("offset * 3 + partition") >= 500])
    paths = ZonePaths(os.path.join(scratch, "raw"), os.path.join(scratch, "processed"),
                      os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"))
    write_zones_batch(_stream(spark, src, maxFilesPerTrigger=1), paths,
                      trigger="availableNow", files_per_partition=2).awaitTermination()
    assert read_zone(spark, paths.raw, "raw_readings").count() == 1000
    day = os.path.join(paths.alerts, sorted(d for d in os.listdir(paths.alerts) if d.startswith("date="))[0])
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 2 * 2  # 2 batches x 2 files
    assert read_zone(spark, paths.processed, "meter_features").count() == 1000
    flagged = _batch_scored(spark).filter("is_fraud_flagged").count()
    assert read_zone(spark, paths.alerts, "fraud_alerts").count() == flagged
    # a second run over the same checkpoint adds nothing
    write_zones_batch(_stream(spark, src, maxFilesPerTrigger=1), paths,
                      trigger="availableNow").awaitTermination()
    assert read_zone(spark, paths.raw, "raw_readings").count() == 1000


def _late_frame(spark, ts_list):
    rows = [(b"m", ('{"meter_id":"m","timestamp":"%s","consumption_kwh":0.1}' % t).encode(),
             "energy_readings", 0, i, None) for i, t in enumerate(ts_list)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_late_rows_kept_by_map_only_dropped_by_timeline(spark, scratch):
    src = os.path.join(scratch, "late")
    # Spark drops rows older than the *previous* batch's watermark, so the
    # year-late row comes two batches after the first on-time rows.
    batches = [["2024-01-02T00:00:10+00:00", "2024-01-02T00:00:20+00:00"],
               ["2024-01-02T00:00:30+00:00"],
               ["2023-01-02T00:00:10+00:00"],
               ["2024-01-02T01:00:00+00:00"]]
    for i, b in enumerate(batches):
        _late_frame(spark, b).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        _stamp(os.path.join(src, f"b{i}"), i)
    scored = apply_rules(add_features(parse_readings(_stream(spark, src, maxFilesPerTrigger=1))))
    q1 = (scored.writeStream.format("memory").queryName("late_all").outputMode("append")
                .trigger(availableNow=True).start())
    q1.awaitTermination()
    assert spark.table("late_all").count() == 5  # the year-late row is still written
    q2 = (stream_timeline(scored).writeStream.format("memory").queryName("late_tl")
              .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck_tl"))
              .trigger(availableNow=True).start())
    q2.awaitTermination()
    minutes = [r.minute.year for r in spark.table("late_tl").collect()]
    assert 2023 not in minutes and minutes.count(2024) >= 1
    assert spark.table("late_tl").agg(F.sum("events")).first()[0] == 3


def test_stream_rollups_match_batch(spark, scratch):
    src = os.path.join(scratch, "src")
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") < 500, F.expr("offset * 3 + partition") >= 500])
    scored = apply_rules(add_features(parse_readings(_stream(spark, src, maxFilesPerTrigger=1))))
    rolls = stream_rollups(scored)
    for name, df in rolls.items():
        (df.writeStream.format("memory").queryName(f"roll_{name}").outputMode("complete")
           .trigger(availableNow=True).start().awaitTermination())
    batch = _batch_scored(spark)
    kpi = spark.table("roll_kpi").first()
    assert kpi.messages == 1000
    assert kpi.fraud_alerts == batch.filter("is_fraud_flagged").count()
    sev = {r.severity: r.events for r in spark.table("roll_severity").collect()}
    exp = {r.fraud_severity: r["count"] for r in batch.groupBy("fraud_severity").count().collect()}
    assert set(sev) == {"HIGH", "MEDIUM", "LOW", "NONE"}
    assert {k: n for k, n in sev.items() if n} == exp
    assert spark.table("roll_kpi").columns == live.kpi_live(batch).columns
    want = live.kpi_live(batch).first()
    assert (kpi.alert_rate_pct, kpi.avg_kwh, kpi.last_event_label) == (want.alert_rate_pct, want.avg_kwh, want.last_event_label)
    assert sorted(spark.table("roll_zones").collect()) == sorted(live.zone_risk(batch).collect())


@pytest.mark.parametrize("variant", ["apply_in_pandas_with_state", "transform_with_state"])
def test_stream_rolling_baseline_equals_batch(spark, scratch, variant):
    rd = readings(spark, SF001)
    src = os.path.join(scratch, "rd")
    days = [r.date for r in rd.select("date").distinct().orderBy("date").collect()]
    for i, d in enumerate(days):
        rd.filter(F.col("date") == d).coalesce(1).write.parquet(os.path.join(src, f"d{i:02d}"))
        _stamp(os.path.join(src, f"d{i:02d}"), i)
    stream = stream_ready(spark.readStream.schema(rd.schema).option("maxFilesPerTrigger", 1)
                          .parquet(os.path.join(src, "*")))
    op = stream_rolling_baseline if variant == "apply_in_pandas_with_state" else stream_rolling_baseline_tws
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider)
    if variant == "transform_with_state":
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    name = f"rolling_{variant}"
    try:
        q = (op(stream).writeStream.format("memory").queryName(name)
             .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck_roll"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(provider, old)
    got = {(r.meter_id, r.timestamp): (r.rolling_mean_kwh, r.rolling_count)
           for r in spark.table(name).collect()}
    exp = {(r.meter_id, r.timestamp): (r.rolling_mean_kwh, r.rolling_count)
           for r in rolling_baseline(rd).collect()}
    assert len(got) == len(exp) == 1000
    for k, (m, n) in exp.items():
        gm, gn = got[k]
        assert gn == n
        assert (m is None and (gm is None or gm != gm)) or abs(gm - m) < 1e-6


def test_malformed_payloads_through_zones(spark, scratch):
    payloads = [b"{bad", b"[1]", b'{"meter_id":"m","consumption_kwh":"abc","date":"2024-01-02"}',
                b'{"meter_id":"m","timestamp":"x","consumption_kwh":0.1}',
                b'{"meter_id":"m","timestamp":"2024-01-02T00:00:00+00:00","date":"2024-01-02",'
                b'"hour":0,"consumption_kwh":0.1,"voltage_v":230,"current_a":1,"frequency_hz":50}']
    rows = [(b"m", p, "energy_readings", 0, i, None) for i, p in enumerate(payloads)]
    src = os.path.join(scratch, "bad")
    spark.createDataFrame(rows, KAFKA_SCHEMA).write.parquet(os.path.join(src, "b0"))
    paths = ZonePaths(os.path.join(scratch, "raw"), os.path.join(scratch, "processed"),
                      os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"))
    for q in run_pipeline(_stream(spark, src), paths, trigger="availableNow", console=False):
        q.awaitTermination()
    raw = read_zone(spark, paths.raw, "raw_readings")
    assert raw.count() == 5  # the stream job keeps undecodable payloads as null rows
    assert raw.filter(F.col("date").isNull()).count() == 3
    assert any(d.startswith("date=__HIVE_DEFAULT_PARTITION__") for d in os.listdir(paths.raw))
    alerts = read_zone(spark, paths.alerts, "fraud_alerts").collect()
    assert len(alerts) == 2  # kWh 0.1 fires the low-consumption rule (twice); nulls do not
    assert all(r.rule_low_consumption for r in alerts)


def test_stream_rolling_baseline_late_row_within_watermark(spark, scratch):
    schema = "meter_id string, timestamp string, event_time timestamp, consumption_kwh double"
    src = os.path.join(scratch, "late_roll")
    batches = [[("m", "a", "2024-01-02 10:00:00", 1.0), ("m", "b", "2024-01-02 10:20:00", 2.0)],
               [("m", "c", "2024-01-02 10:15:00", 4.0)],            # out of order, within the watermark
               [("m", "d", "2024-01-02 10:30:00", 8.0)]]
    for i, rows in enumerate(batches):
        (spark.createDataFrame(rows, "meter_id string, timestamp string, t string, consumption_kwh double")
              .select("meter_id", "timestamp", F.to_timestamp("t").alias("event_time"), "consumption_kwh")
              .coalesce(1).write.parquet(os.path.join(src, f"b{i}")))
        _stamp(os.path.join(src, f"b{i}"), i)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    (stream_rolling_baseline(stream).writeStream.format("memory").queryName("late_roll")
        .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True).start().awaitTermination())
    got = {r.timestamp: (r.rolling_mean_kwh, r.rolling_count) for r in spark.table("late_roll").collect()}
    assert got["a"][1] == 0 and got["b"] == (1.0, 1)
    assert got["c"] == (1.0, 1)            # only 10:00 precedes 10:15 within 30 minutes
    assert got["d"] == (round((1 + 2 + 4) / 3, 6), 3)  # the late reading is in the state


def test_pipeline_clustered_writes(spark, scratch):
    src = os.path.join(scratch, "src")
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") < 500, F.expr("offset * 3 + partition") >= 500])
    paths = ZonePaths(os.path.join(scratch, "raw"), os.path.join(scratch, "processed"),
                      os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"))
    for q in run_pipeline(_stream(spark, src, maxFilesPerTrigger=1), paths, trigger="availableNow",
                          console=False, files_per_partition=1):
        q.awaitTermination()
    assert read_zone(spark, paths.processed, "meter_features").count() == 1000
    day = os.path.join(paths.alerts, sorted(d for d in os.listdir(paths.alerts) if d.startswith("date="))[0])
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 2  # one per batch
