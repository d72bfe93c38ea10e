"""Live KPIs on edge inputs (FIXTURES.md §3)."""

from meterlens.functions import score_live
from meterlens.operators.live import kpi_live, severity_mix, zone_risk


def _scored(spark, rows):
    df = spark.createDataFrame(rows, "meter_id string, location string, timestamp string, "
                                     "consumption_kwh string, voltage_v string, current_a string, "
                                     "frequency_hz string, hour string")
    return score_live(df)


def test_severity_mix_zero_filled(spark):
    rows = [("m", "Zone_A", "2024-01-01T00:00:00+00:00", "0.1", "230", "1", "50", "12")] * 3
    got = [(r.severity, r.events) for r in severity_mix(_scored(spark, rows)).collect()]
    assert got == [("NONE", 0), ("LOW", 3), ("MEDIUM", 0), ("HIGH", 0)]


def test_kpis_on_empty_window(spark):
    empty = _scored(spark, [])
    k = kpi_live(empty).first()
    assert (k.messages, k.fraud_alerts, k.alert_rate_pct, k.active_meters, k.avg_kwh) == (0, 0, 0.0, 0, 0.0)
    assert k.last_event_time is None
    assert [r.events for r in severity_mix(empty).collect()] == [0, 0, 0, 0]
    assert zone_risk(empty).count() == 0


def test_zone_risk_half_even_and_null_location(spark):
    rows = ([("m1", "Zone_A", "2024-01-01T00:00:00+00:00", "0.1", "230", "1", "50", "12")] * 1
            + [("m1", "Zone_A", "2024-01-01T00:00:00+00:00", "3.0", "230", "1", "50", "12")] * 7
            + [("m2", None, "2024-01-01T00:00:00+00:00", "0.1", "230", "1", "50", "12")])
    got = [(r.location, r.events, r.alerts, r.risk_rate) for r in zone_risk(_scored(spark, rows)).collect()]
    assert got == [("Zone_A", 8, 1, 12.5)]  # 1/8 = 12.5 %, the null location is dropped
