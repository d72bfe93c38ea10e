"""Hand rewrites against the literal formulation."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlens.operators.timeseries import q3_2_day_change, q3_2_day_change_true
from meterlens.plans.joins import join_small
from meterlens.plans.windows import epoch_micros, preceding_range_agg


def _day_rows(spark):
    rows = [("m1", "2024-01-01", 1.0), ("m1", "2024-01-01", 2.0),
            ("m1", "2024-01-02", 5.0), ("m1", "2024-01-02", 6.0), ("m1", "2024-01-02", 7.0),
            ("m2", "2024-01-02", 7.0)]
    return spark.createDataFrame(rows, "meter_id string, date string, consumption_kwh double")


def test_day_change_verbatim_fanout(spark):
    out = [tuple(r) for r in q3_2_day_change(_day_rows(spark)).collect()]
    assert out == [("m1", "2024-01-02", 36.0, 9.0, 300.0)]


def test_day_change_corrected(spark):
    out = [tuple(r) for r in q3_2_day_change_true(_day_rows(spark)).collect()]
    assert out == [("m1", "2024-01-02", 18.0, 3.0, 500.0)]


def test_day_change_equals_literal_join(spark):
    random.seed(7)
    rows = [(f"m{random.randint(1, 3)}", f"2024-01-0{random.randint(1, 6)}", round(random.random() * 9, 3))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "meter_id string, date string, consumption_kwh double")
    df.createOrReplaceTempView("dc_raw")
    literal = spark.sql("""
        SELECT * FROM (
          SELECT a.meter_id, a.date AS today,
                 ROUND(SUM(a.consumption_kwh), 3) AS today_kwh,
                 ROUND(SUM(b.consumption_kwh), 3) AS yesterday_kwh,
                 CAST(ROUND((SUM(a.consumption_kwh) - SUM(b.consumption_kwh)) * 100.0
                       / NULLIF(SUM(b.consumption_kwh), 0), 2) AS DOUBLE) AS change_pct
          FROM dc_raw a LEFT JOIN dc_raw b
            ON a.meter_id = b.meter_id AND DATE_SUB(a.date, 1) = b.date
          GROUP BY a.meter_id, a.date) WHERE ABS(change_pct) > 30""")
    key = lambda r: (r.meter_id, r.today)
    got = sorted(q3_2_day_change(df).collect(), key=key)
    exp = sorted(literal.collect(), key=key)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert (g.meter_id, g.today) == (e.meter_id, e.today)
        assert abs(g.today_kwh - e.today_kwh) < 1e-6 and abs(g.change_pct - e.change_pct) < 0.011


def test_bucketed_window_equals_plain_window(spark):
    random.seed(3)
    base = 1_704_067_200
    rows = [(f"m{random.randint(1, 4)}", base + random.randint(0, 3 * 86400), round(random.random(), 3))
            for _ in range(2000)]
    df = (spark.createDataFrame(rows, "k string, s long, v double")
               .withColumn("ts", F.timestamp_seconds("s")))
    got = preceding_range_agg(df, "k", "ts", {"m": F.avg("v"), "n": F.count("v")},
                              window="30 minutes", bucket="2 hours")
    w = Window.partitionBy("k").orderBy(epoch_micros(df, "ts")).rangeBetween(-1_800_000_000, -1)
    exp = df.withColumn("m", F.avg("v").over(w)).withColumn("n", F.count("v").over(w))
    key = lambda r: (r.k, r.s, r.v, r.n)
    g, e = sorted(got.collect(), key=key), sorted(exp.collect(), key=key)
    assert len(g) == len(e) == 2000
    for a, b in zip(g, e):
        assert a.n == b.n
        assert (a.m is None and b.m is None) or abs(a.m - b.m) < 1e-9


def test_join_small_broadcasts_only_within_bound(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    plan = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    plan = join_small(big, small, "k", max_rows=5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    assert join_small(big, small, "k", max_rows=5).count() == 1000


def test_day_change_tolerates_bad_dates(spark):
    df = _day_rows(spark).union(spark.createDataFrame([("m1", "not-a-date", 1.0)], _day_rows(spark).schema))
    out = [tuple(r) for r in q3_2_day_change(df).collect()]
    assert out == [("m1", "2024-01-02", 36.0, 9.0, 300.0)]


def test_join_small_respects_byte_threshold(spark):
    big = spark.range(5000).withColumn("k", F.col("id") % 2000)
    small = big.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        plan = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cluster_conf_sizes_for_100tb():
    from meterlens.config import cluster_conf
    conf = cluster_conf(100 << 40, 8000)
    n = int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert 50_000 < n < 120_000 and conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(cluster_conf(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 24
