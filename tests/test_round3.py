"""Hot meters in the streaming baseline, one rollup state, one report scan, consumer lag."""

import os

import pytest
from pyspark.sql import functions as F

from meterlens.functions import add_features, apply_rules
from meterlens.operators import live, summary
from meterlens.operators.baseline import rolling_baseline
from meterlens.queries import meter_features
from meterlens.sources import kafka
from meterlens.sources.events import kafka_records, readings
from meterlens.sources.kafka import parse_readings
from meterlens.streaming.rollups import rollups_of, stream_minute_state
from meterlens.streaming.state import _bucketed, stream_rolling_baseline
from meterlens.streaming.zones import stream_ready
from tests.conftest import SF001
from tests.test_streaming import _stream, _write_kafka_files


def _hot(spark):
    """One meter with a third of the rows, dense in time, and some undated rows."""
    rd = readings(spark, SF001).select("meter_id", "timestamp", "event_time", "consumption_kwh")
    hot = spark.range(500).select(
        F.lit("HOT").alias("meter_id"), F.concat(F.lit("h"), "id").alias("timestamp"),
        F.when(F.col("id") % 50 != 49, F.expr("timestampadd(SECOND, CAST(id * 37 AS INT), TIMESTAMP_NTZ'2024-01-10 00:00:00')")).alias("event_time"),
        (F.col("id") % 7).cast("double").alias("consumption_kwh"))
    return rd.unionByName(hot)


def test_streaming_baseline_splits_a_hot_meter(spark, scratch):
    rd = _hot(spark)
    src = os.path.join(scratch, "rd")
    rd.coalesce(1).write.parquet(os.path.join(src, "all"))
    stream = stream_ready(spark.readStream.schema(rd.schema).parquet(os.path.join(src, "*")))
    (stream_rolling_baseline(stream).writeStream.format("memory").queryName("hot_roll").outputMode("append")
        .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start().awaitTermination())
    got = {(r.meter_id, r.timestamp): (r.rolling_mean_kwh, r.rolling_count) for r in spark.table("hot_roll").collect()}
    want = {(r.meter_id, r.timestamp): (r.rolling_mean_kwh, r.rolling_count) for r in rolling_baseline(rd).collect()}
    assert len(got) == len(want) == rd.count()
    for k, (mean, n) in want.items():
        assert (got[k][1] or 0) == (n or 0), k
        assert (mean is None and (got[k][0] is None or got[k][0] != got[k][0])) or abs(got[k][0] - mean) < 1e-6
    half, hour = 1_800_000_000, 3_600_000_000
    groups = _bucketed(stream_ready(rd), half, hour).filter("meter_id = 'HOT'").groupBy("bucket").count()
    assert groups.agg(F.max("count")).first()[0] <= 160  # 97 readings an hour and the half hour before


def test_bucket_narrower_than_window_is_refused(spark):
    with pytest.raises(ValueError):
        _bucketed(stream_ready(_hot(spark)), 2, 1)


def test_one_state_gives_all_rollups(spark, scratch):
    src = os.path.join(scratch, "src")
    _write_kafka_files(spark, src, [F.expr("offset * 3 + partition") < 500, F.expr("offset * 3 + partition") >= 500])
    scored = apply_rules(add_features(parse_readings(_stream(spark, src, maxFilesPerTrigger=1))))
    (stream_minute_state(scored).writeStream.format("memory").queryName("minute_state").outputMode("complete")
        .trigger(availableNow=True).start().awaitTermination())
    got = rollups_of(spark.table("minute_state"))
    batch = apply_rules(add_features(parse_readings(kafka_records(spark, SF001))))
    assert got["kpi"].collect() == live.kpi_live(batch).collect()
    assert sorted(got["severity"].collect()) == sorted(live.severity_mix(batch).collect())
    assert sorted(got["zones"].collect()) == sorted(live.zone_risk(batch).collect())
    empty = rollups_of(spark.table("minute_state").limit(0))
    assert empty["kpi"].first().messages == 0 and empty["kpi"].first().active_meters == 0


def test_report_frames_equal_the_single_queries(spark):
    mf = meter_features(spark, SF001)
    mf = mf.unionByName(mf.limit(3).withColumns({"hour": F.lit(None).cast("int"), "location": F.lit(None).cast("string"),
                                                 "date": F.lit(None).cast("string")}))
    frames = summary.report_frames(mf)
    single = {"summary": summary.report_summary, "hourly": summary.report_hourly,
              "daily_trend": summary.report_daily_trend, "severity": summary.report_severity}
    for name, op in single.items():
        want = op(mf)
        assert frames[name].columns == want.columns
        assert sorted(map(str, frames[name].collect())) == sorted(map(str, want.collect())), name
    plan = frames["hourly"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan  # the frames read the checkpoint


def test_consumer_lag_of_a_stopped_stream(spark, scratch):
    ck = os.path.join(scratch, "ck")
    for kind in ("offsets", "commits"):
        os.makedirs(os.path.join(ck, kind))
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":1,"conf":{}}'
    for batch, at in ((2, '{"energy_readings":{"0":10,"1":20}}'), (10, '{"energy_readings":{"0":100,"1":334}}'),
                      (11, '{"energy_readings":{"0":300,"1":334}}')):
        with open(os.path.join(ck, "offsets", str(batch)), "w") as f:
            f.write(f"v1\n{meta}\n{at}")
    for batch in (2, 10):  # batch 11 was planned and not finished
        with open(os.path.join(ck, "commits", str(batch)), "w") as f:
            f.write("v1\n{\"nextBatchWatermarkMs\":0}")
    committed = kafka.committed_offsets(spark, ck)
    topic = kafka_records(spark, SF001)
    got = {r.partition: (r.begin_offset, r.end_offset, r.committed, r.lag) for r in kafka.consumer_lag(topic, committed).collect()}
    ends = {r.partition: (r.begin_offset, r.end_offset) for r in kafka.topic_partition_stats(topic).collect()}
    assert got == {0: (*ends[0], 100, ends[0][1] - 100), 1: (*ends[1], 334, max(0, ends[1][1] - 334)), 2: (*ends[2], None, ends[2][1])}
    os.makedirs(os.path.join(scratch, "new", "commits"))
    assert kafka.committed_offsets(spark, os.path.join(scratch, "new")).count() == 0


@pytest.mark.parametrize("accuracy", [2, 50, 10000])
def test_interpolated_quantiles_equal_percentile(spark, accuracy):
    from meterlens.operators.quantiles import group_key, interpolated_quantiles
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, "big").when(F.col("id") < 3001, "one").when(F.col("id") < 3003, "two")
         .when(F.col("id") < 3010, None).otherwise(F.concat(F.lit("g"), F.col("id") % 9)).alias("k"),
        F.when(F.col("id") % 11 != 5, (F.xxhash64("id") % 700) / 7.0).alias("x"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r[0]: r[1] for r in interpolated_quantiles(df, ["k"], "x", probs, accuracy).collect()}
    want = df.groupBy(group_key(["k"]).alias("_key")).agg(F.percentile("x", F.array(*map(F.lit, probs)))).collect()
    assert len(got) == len([r for r in want if r[1]])
    for key, q in want:
        if q:
            assert all(abs(a - b) < 1e-9 for a, b in zip(got[key], q)), key
