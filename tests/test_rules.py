"""Boundary and null behaviour of the stream rules and the live scoring."""

import math

import pytest
from pyspark.sql import functions as F

from meterlens.functions import add_features, apply_rules, score_live
from meterlens.schema import READING_SCHEMA

NEUTRAL = dict(meter_id="m", location="Zone_A", timestamp="2024-01-15T12:00:00.000000+00:00",
               date="2024-01-15", hour=12, consumption_kwh=3.0, voltage_v=230.0,
               current_a=13.0, power_factor=0.9, frequency_hz=50.0, _injected_fraud=False)


def frame(spark, rows):
    data = [tuple({**NEUTRAL, **r}[f] for f in READING_SCHEMA.fieldNames()) for r in rows]
    df = spark.createDataFrame(data, READING_SCHEMA)
    return df.withColumn("event_time", F.try_to_timestamp("timestamp"))


def scored(spark, rows, **kw):
    return apply_rules(add_features(frame(spark, rows)), **kw).collect()


@pytest.mark.parametrize("kwh,expect", [(0.30, False), (0.29, True)])
def test_r1_edge(spark, kwh, expect):
    assert scored(spark, [dict(consumption_kwh=kwh)])[0].rule_low_consumption is expect


@pytest.mark.parametrize("v,expect", [(245.0, False), (245.1, True)])
def test_r2_edge(spark, v, expect):
    assert scored(spark, [dict(voltage_v=v)])[0].rule_voltage_spike is expect


def test_r3_edge_and_guard(spark):
    # ratio = V*A / (kWh*30000); kWh 1.0 -> expected 30000 W
    rows = scored(spark, [dict(consumption_kwh=1.0, voltage_v=230.0, current_a=30000 * 1.15 / 230.0),
                          dict(consumption_kwh=1.0, voltage_v=230.0, current_a=30000 * 1.1501 / 230.0),
                          dict(consumption_kwh=0.0)])
    assert rows[0].power_ratio == 1.15 and rows[0].rule_power_inconsistency is False
    assert rows[1].rule_power_inconsistency is True
    assert rows[2].power_ratio is None and rows[2].rule_power_inconsistency is False
    assert rows[2].rule_low_consumption is True


def test_r4_edge(spark):
    rows = scored(spark, [dict(hour=5, consumption_kwh=5.0), dict(hour=5, consumption_kwh=5.01),
                          dict(hour=6, consumption_kwh=5.01), dict(hour=0, consumption_kwh=5.01)])
    assert [r.rule_odd_hour_spike for r in rows] == [False, True, False, True]


def test_r5_edge(spark):
    rows = scored(spark, [dict(frequency_hz=x) for x in (49.8, 50.2, 49.79, 50.21)])
    assert [r.rule_frequency_anomaly for r in rows] == [False, False, True, True]


def test_severity_levels(spark):
    rows = scored(spark, [
        dict(),
        dict(consumption_kwh=0.1),
        dict(consumption_kwh=0.1, voltage_v=250.0),
        dict(consumption_kwh=0.1, voltage_v=250.0, frequency_hz=51.0),
    ])
    assert [r.fraud_severity for r in rows] == ["NONE", "LOW", "MEDIUM", "HIGH"]
    assert [r.rules_fired_count for r in rows] == [0, 1, 2, 3]


def test_null_voltage_quirks(spark):
    rows = scored(spark, [dict(consumption_kwh=0.1, voltage_v=None), dict(voltage_v=None)])
    assert rows[0].is_fraud_flagged is True
    assert rows[0].rules_fired_count is None and rows[0].fraud_severity == "NONE"
    assert rows[1].is_fraud_flagged is None


def test_null_safe_mode(spark):
    rows = scored(spark, [dict(consumption_kwh=0.1, voltage_v=None)], nulls="false")
    assert rows[0].rules_fired_count == 1 and rows[0].fraud_severity == "LOW"


def test_null_frequency_stream_vs_live(spark):
    assert scored(spark, [dict(frequency_hz=None)])[0].rule_frequency_anomaly is False
    live = score_live(frame(spark, [dict(frequency_hz=None)])).collect()[0]
    assert live.rule_frequency_anomaly is True and live.is_fraud_flagged is True


def test_nan_voltage_stream(spark):
    r = scored(spark, [dict(voltage_v=float("nan"))])[0]
    # Spark orders NaN above every number: the spike rule fires
    assert r.rule_voltage_spike is True


def test_live_text_coercion(spark):
    df = spark.createDataFrame(
        [("m", "abc", None, "2024-01-15T03:10:00+00:00", "49.9"),
         ("m", "3.5", "2", "bad", "50.0"),
         ("m", "NaN", None, "2024-01-15T03:10:00+00:00", "50.0")],
        "meter_id string, consumption_kwh string, hour string, timestamp string, frequency_hz string")
    rows = score_live(df).collect()
    assert rows[0].consumption_kwh is None and rows[0].hour == 3.0  # UTC hour fallback
    assert rows[0].rule_frequency_anomaly is False
    assert rows[1].consumption_kwh == 3.5 and rows[1].event_time is None and rows[1].hour == 2.0
    assert rows[1].minute is None
    assert rows[2].consumption_kwh is None  # NaN treated as missing
    # voltage and current missing everywhere: rules 2-3 false, never null
    assert all(r.rule_voltage_spike is False and r.rule_power_inconsistency is False for r in rows)


def test_live_unrounded_ratio(spark):
    r = score_live(frame(spark, [dict(voltage_v=231.123, current_a=13.3333)])).collect()[0]
    assert math.isclose(r.computed_power_w, 231.123 * 13.3333, rel_tol=0, abs_tol=0)
