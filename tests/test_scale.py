"""Undated rows, non-finite readings, exact quantiles, file counts, offset pushdown."""

import os
import random
from collections import defaultdict
from datetime import datetime, timedelta
from math import ceil, inf, isnan, nan

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlens.operators.baseline import rolling_baseline
from meterlens.operators.quantiles import exact_quantiles, group_key
from meterlens.queries import meter_features, raw_readings
from meterlens.sources import kafka
from meterlens.sources.catalog import copy_zone_orc, run_query, write_zone
from meterlens.sources.events import kafka_records
from meterlens.streaming.state import _rolling_step
from tests.conftest import SF001


def test_undated_rows_go_around_the_window(spark):
    rd = raw_readings(spark, SF001)
    rd = rd.withColumn("event_time", F.when(F.col("event_id") % 10 < 7, F.col("event_time")))
    out = rolling_baseline(rd)
    assert out.count() == rd.count()
    undated = out.filter("event_time IS NULL")
    assert undated.count() == rd.filter("event_time IS NULL").count() > 0
    assert undated.filter("rolling_mean_kwh IS NOT NULL OR rolling_count IS NOT NULL").count() == 0
    # the undated branch of the union holds neither window nor shuffle
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    branch = plan[plan.rindex("isnull(event_time"):] if "isnull(event_time" in plan else plan[plan.rindex("isnull("):]
    assert "Union" in plan and "Window" not in branch


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stream_step_equals_batch_on_odd_readings(spark, seed):
    """NaN, infinite, missing, undated and tied readings, over two micro-batches in time order."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 2)
    rows = []
    for i in range(240):
        t = None if rng.random() < 0.1 else start + timedelta(minutes=rng.randrange(0, 600))
        v = rng.choice([nan, inf, -inf, None]) if rng.random() < 0.2 else rng.uniform(0, 5)
        rows.append((i, "m", t, v))
    batch = spark.createDataFrame(rows, "id long, meter_id string, event_time timestamp, consumption_kwh double")
    want = {r.id: (r.rolling_mean_kwh, r.rolling_count) for r in rolling_baseline(batch).collect()}
    got, h_ts, h_kwh = {}, pd.Series([], dtype="int64").to_numpy(), pd.Series([], dtype=float).to_numpy()
    cut = start + timedelta(minutes=300)
    for part in ([r for r in rows if r[2] and r[2] < cut], [r for r in rows if not (r[2] and r[2] < cut)]):
        us = [int((t - datetime(1970, 1, 1)).total_seconds() * 1_000_000) if t else None for _, _, t, _ in part]
        frame = pd.DataFrame({"meter_id": "m", "timestamp": [str(r[0]) for r in part], "event_time": [r[2] for r in part],
                              "consumption_kwh": pd.Series([r[3] for r in part], dtype=float),
                              "event_us": pd.Series(us, dtype=float)})
        out, h_ts, h_kwh = _rolling_step(h_ts, h_kwh, frame, 30 * 60 * 1_000_000)
        for k, m, n in zip(out["timestamp"], out["rolling_mean_kwh"], out["rolling_count"]):
            got[int(k)] = (None if isnan(m) else m, None if n is pd.NA else int(n))
    assert got.keys() == want.keys()
    for k, (m, n) in want.items():
        assert got[k][1] == n
        assert (m is None) == (got[k][0] is None) and (m is None or abs(m - got[k][0]) < 2e-6)


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_exact_quantiles_equal_brute_force(spark, accuracy):
    rng = random.Random(4)
    rows = [("hot", "a", rng.choice([1.0, 2.0, rng.gauss(5, 2)])) for _ in range(6000)]
    rows += [("few", None, x) for x in (3.0, 1.0, 2.0, None)] + [(None, "b", 7.0), ("none", "c", None)]
    df = spark.createDataFrame(rows, "m string, l string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    want = defaultdict(list)
    for m, l, v in rows:
        if v is not None:
            want[m, l].append(v)
    want = {k: [sorted(x)[max(1, ceil(p * len(x))) - 1] for p in probs] for k, x in want.items()}
    keys = df.select("m", "l", group_key(["m", "l"]).alias("_key")).distinct()
    got = exact_quantiles(df, ["m", "l"], "v", probs, accuracy).join(keys, "_key")
    assert {(r.m, r.l): r.q for r in got.collect()} == want


def test_exact_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "m string, v double")
    assert exact_quantiles(df, ["m"], "v", [0.5]).count() == 0


def test_zone_writes_are_bounded_in_files(spark, scratch):
    mf = meter_features(spark, SF001).repartition(24)
    write_zone(mf, os.path.join(scratch, "z"), "meter_features", files_per_partition=2)
    copy_zone_orc(mf, os.path.join(scratch, "o"), files_per_partition=2)
    for base, end in (("z", ".parquet"), ("o", ".orc")):
        most = max(sum(f.endswith(end) for f in files) for _, _, files in os.walk(os.path.join(scratch, base)))
        assert 1 <= most <= 2
    assert spark.read.orc(os.path.join(scratch, "o")).count() == mf.count()


def test_run_query(spark):
    assert run_query(spark, "SELECT 1 AS x, 'y' AS z").first().asDict() == {"x": 1, "z": "y"}


def test_latest_messages_push_the_lowest_offset_to_the_scan(spark, scratch):
    path = os.path.join(scratch, "topic")
    kafka_records(spark, SF001).write.parquet(path)
    out = kafka.latest_messages(spark.read.parquet(path), 60)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset" in plan
    assert out.count() == 60


class _Reader:
    """Records what a Kafka reader is asked for; there is no broker here."""

    def __init__(self):
        self.kind, self.options = None, {}

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, k, v):
        self.options[k] = v
        return self

    def load(self):
        return self


class _Session:
    def __init__(self):
        self.read = self.readStream = _Reader()


def test_kafka_readers_options():
    s = kafka.read_kafka_stream(_Session(), "h:9092", "t", "earliest", maxOffsetsPerTrigger="5")
    assert s.kind == "kafka" and s.options == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5"}
    b = kafka.read_kafka_batch(_Session(), "h:9092", "t", kafka.starting_offsets({0: 3, 1: 0}, {0: 10, 1: 900}, "t", 20))
    assert b.kind == "kafka" and b.options == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "endingOffsets": "latest",
        "startingOffsets": '{"t": {"0": 3, "1": 889}}'}
