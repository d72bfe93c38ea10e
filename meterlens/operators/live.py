"""Live KPIs and rollups over ``score_live`` output (dashboard questions).

All are single aggregates or bounded top-k; none collects rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.config import LIVE_ALERT_ROWS, LIVE_MAX_MESSAGES, LIVE_RECENT_ROWS, SEVERITY_LABELS
from meterlens.operators.rule_stats import unpivot_sums

RECENT_COLUMNS = ["event_time", "meter_id", "location", "consumption_kwh", "voltage_v",
                  "frequency_hz", "fraud_severity", "rules_fired_count"]
ALERT_COLUMNS = [
    "event_time", "meter_id", "location", "consumption_kwh", "voltage_v", "frequency_hz",
    "fraud_severity", "rules_fired_count", "rule_low_consumption", "rule_voltage_spike",
    "rule_power_inconsistency", "rule_odd_hour_spike", "rule_frequency_anomaly",
]


def _tie_break(df: DataFrame, descending: bool = False) -> list:
    """Columns that make an event-time order total (Kafka position if known)."""
    keys = [c for c in ("partition", "offset") if c in df.columns] or ["meter_id", "timestamp"]
    return [F.desc_nulls_first(c) if descending else F.asc_nulls_last(c) for c in keys]


def live_window(kafka: DataFrame, max_messages: int = LIVE_MAX_MESSAGES) -> DataFrame:
    """The dashboard's refresh: newest ``max_messages`` records -> tolerant
    decode -> live scoring.  Every K-operator can run on its output."""
    from meterlens.functions.rules import score_live
    from meterlens.sources.kafka import decode_live, latest_messages
    return score_live(decode_live(latest_messages(kafka, max_messages)))


def kpi_live(scored: DataFrame) -> DataFrame:
    """Messages, alerts, alert rate (1 dp), active meters, mean kWh (2 dp),
    last event time and its ``HH:MM:SS UTC`` label; zeros when empty."""
    return kpi_row(scored, F.countDistinct("meter_id"))


def kpi_row(scored: DataFrame, active_meters: Column) -> DataFrame:
    """``kpi_live`` with the given aggregate for the active meters."""
    out = scored.agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.col("is_fraud_flagged").cast("int")), F.lit(0)).cast("long").alias("fraud_alerts"),
        active_meters.alias("active_meters"),
        F.avg("consumption_kwh").alias("_avg"),
        F.max("event_time").alias("last_event_time"))
    return out.select(
        "messages", "fraud_alerts",
        F.when(F.col("messages") == 0, F.lit(0.0))
         .otherwise(F.round(F.col("fraud_alerts") / F.col("messages") * 100, 1)).alias("alert_rate_pct"),
        "active_meters",
        F.when(F.col("messages") == 0, F.lit(0.0)).otherwise(F.round("_avg", 2)).alias("avg_kwh"),
        "last_event_time",
        F.date_format("last_event_time", "HH:mm:ss 'UTC'").alias("last_event_label"))


def timeline_minute(scored: DataFrame) -> DataFrame:
    """Events per (minute, flag); rows without a time are dropped."""
    return (scored.filter(F.col("minute").isNotNull())
                  .groupBy("minute", "is_fraud_flagged").agg(F.count(F.lit(1)).alias("events"))
                  .orderBy("minute", "is_fraud_flagged"))


def severity_mix(scored: DataFrame) -> DataFrame:
    """Events per severity, all four labels present (missing -> 0)."""
    sev = F.col("fraud_severity")
    counts = scored.agg(*[F.count_if(sev == s).alias(s) for s in SEVERITY_LABELS])
    return unpivot_sums(counts, list(SEVERITY_LABELS), "severity", "events")


def zone_risk(scored: DataFrame) -> DataFrame:
    """Per location: events (non-null meter ids), alerts, risk rate (1 dp,
    half-even like pandas); rows without a location are dropped."""
    out = (scored.filter(F.col("location").isNotNull())
                 .groupBy("location").agg(
                     F.count("meter_id").alias("events"),
                     F.sum(F.col("is_fraud_flagged").cast("int")).alias("alerts")))
    rate = F.try_divide(F.col("alerts").cast("double"), F.col("events")) * 100
    return (out.withColumn("risk_rate", F.bround(rate, 1))
               .orderBy(F.desc("alerts"), "location"))


def recent_readings(scored: DataFrame, rows: int = LIVE_RECENT_ROWS) -> DataFrame:
    """The last ``rows`` readings of the event-time order (ascending, missing
    times last, ties by Kafka position), newest first: a missing time
    counts as latest, as in the dashboard's tail."""
    order = [F.desc_nulls_first("event_time")] + _tie_break(scored, descending=True)
    return scored.orderBy(*order).limit(rows).select(*RECENT_COLUMNS)


def latest_alerts(scored: DataFrame, rows: int = LIVE_ALERT_ROWS) -> DataFrame:
    """Newest ``rows`` flagged readings, 13 columns."""
    order = [F.desc_nulls_last("event_time")] + _tie_break(scored)
    return (scored.filter(F.col("is_fraud_flagged"))
                  .orderBy(*order).limit(rows).select(*ALERT_COLUMNS))
