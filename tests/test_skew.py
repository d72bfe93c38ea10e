"""A meter holding ~40 % of all readings: same answers, bounded partitions."""

from pyspark.sql import functions as F

from meterlens.operators import outliers
from meterlens.operators.baseline import rolling_baseline
from meterlens.plans import joins
from meterlens.queries import raw_readings
from tests.conftest import SF01


def skewed(spark):
    rd = raw_readings(spark, SF01)
    hot = F.col("meter_id").isin("MTR_001", "MTR_002", "MTR_003", "MTR_004")
    return rd.withColumn("meter_id", F.when(hot, F.lit("MTR_001")).otherwise(F.col("meter_id")))


def test_zscore_same_on_broadcast_and_shuffle_paths(spark, monkeypatch):
    rd = skewed(spark)
    assert rd.filter(F.col("meter_id") == "MTR_001").count() / rd.count() > 0.35
    broadcast = [tuple(r) for r in outliers.q4_1_zscore(rd).collect()]
    orig = joins.join_small
    monkeypatch.setattr(outliers, "join_small", lambda b, s, on, how="inner": orig(b, s, on, how, max_rows=0))
    shuffled_df = outliers.q4_1_zscore(rd)
    plan = shuffled_df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    assert [tuple(r) for r in shuffled_df.collect()] == broadcast


def test_rolling_partitions_bounded_by_bucket(spark):
    rd = skewed(spark)
    hot_rows = rd.filter(F.col("meter_id") == "MTR_001").count()
    # rows per (meter, 6-hour bucket) partition of the window, context rows included
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', event_time)")
    b = F.floor(us / 21_600_000_000)
    per = rd.groupBy("meter_id", b.alias("b")).count().agg(F.max("count")).first()[0]
    assert per * 2 < hot_rows / 20  # a partition holds a sliver of the hot meter
    out = rolling_baseline(rd)
    assert out.count() == rd.count()


def test_join_small_shuffle_path_lets_aqe_split_a_hot_key(spark):
    # half of all rows share one key; the per-key side exceeds max_rows, so no broadcast
    big = (spark.range(200_000)
                .select(F.when(F.col("id") % 10 < 5, F.lit(0)).otherwise(F.col("id") % 10).alias("k"), "id")
                .repartition(8))
    per_key = big.groupBy("k").agg(F.count("*").alias("n"))
    confs = {"spark.sql.adaptive.enabled": "true",
             "spark.sql.adaptive.skewJoin.enabled": "true",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        j = joins.join_small(big, per_key, "k", max_rows=5)
        assert j.count() == 200_000
        j.collect()
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "BroadcastExchange" not in plan
    assert "SortMergeJoin(skew=true)" in plan  # the hot key's partition ran as several tasks
