"""Continuous versions of the live dashboard's rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.config import SEVERITY_LABELS, WATERMARK_DELAY
from meterlens.operators.live import kpi_row, severity_mix
from meterlens.operators.rule_stats import unpivot_sums


def with_watermark(df: DataFrame, watermark: str | None, col: str = "event_time") -> DataFrame:
    """Set the event-time watermark unless the plan already defines one
    (``parse_readings`` sets it on streams; redefining is refused)."""
    if not watermark:
        return df
    try:
        if "EventTimeWatermark" in df._jdf.queryExecution().logical().toString():
            return df
    except Exception:  # plan not inspectable (e.g. Spark Connect)
        pass
    return df.withWatermark(col, watermark)


def stream_timeline(scored: DataFrame, watermark: str = WATERMARK_DELAY,
                    flag: str = "is_fraud_flagged") -> DataFrame:
    """Events per (1-minute event-time window, flag).

    With the watermark a minute is emitted once (append mode) after it can
    no longer change; rows older than the watermark are dropped (Spark
    compares them with the watermark of the previous micro-batch).  State
    is one counter per open minute and flag value.
    """
    return (with_watermark(scored, watermark)
                  .groupBy(F.window("event_time", "1 minute"), F.col(flag))
                  .agg(F.count(F.lit(1)).alias("events"))
                  .select(F.col("window.start").alias("minute"), F.col(flag), "events"))


def stream_rollups(scored: DataFrame) -> dict[str, DataFrame]:
    """KPI row, severity counts and zone risk as running aggregates, with the
    columns of ``kpi_live``, ``severity_mix`` (all four labels) and ``zone_risk``.

    Meant for ``complete``/``update`` output; state is one row per
    severity / location plus one KPI row.  Active meters use
    ``approx_count_distinct`` so the state does not grow with the fleet.
    """
    flag = F.col("is_fraud_flagged").cast("int")
    kpi = kpi_row(scored, F.approx_count_distinct("meter_id"))
    severity = severity_mix(scored)
    zones = (scored.filter(F.col("location").isNotNull()).groupBy("location").agg(
                F.count("meter_id").alias("events"), F.sum(flag).alias("alerts"))
             .withColumn("risk_rate", F.bround(F.try_divide(F.col("alerts").cast("double"),
                                                             F.col("events")) * 100, 1)))
    return {"kpi": kpi, "severity": severity, "zones": zones}


def stream_minute_state(scored: DataFrame) -> DataFrame:
    """One mergeable state for all rollups: a row per (minute, location,
    severity) with counts, sums, the newest event time and an HLL sketch of the meters.

    One source read and one stateful query; use ``update`` or ``complete``
    output and keep the newest row of each key.  ``rollups_of`` derives the dashboard's
    frames from any union of such rows, over any span of minutes.
    """
    return scored.groupBy(F.date_trunc("minute", "event_time").alias("minute"), "location", "fraud_severity").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.col("is_fraud_flagged").cast("int")).alias("alerts"),
        F.count("meter_id").alias("with_meter"), F.sum("consumption_kwh").alias("kwh_sum"),
        F.count("consumption_kwh").alias("kwh_count"), F.max("event_time").alias("last_event_time"),
        F.hll_sketch_agg("meter_id").alias("meters"))


def rollups_of(state: DataFrame) -> dict[str, DataFrame]:
    """``kpi``, ``severity`` and ``zones`` from rows of ``stream_minute_state``,
    with the columns of ``kpi_live``, ``severity_mix`` and ``zone_risk``.
    Active meters are the merged sketches' estimate (about 1.6 %, nearly exact for small fleets)."""
    messages, alerts = (F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("messages", "alerts"))
    kpi = state.agg(messages.alias("messages"), alerts.alias("fraud_alerts"),
                    F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("meters")), F.lit(0)).alias("active_meters"),
                    (F.sum("kwh_sum") / F.nullif(F.sum("kwh_count"), F.lit(0))).alias("_avg"),
                    F.max("last_event_time").alias("last_event_time"))
    kpi = kpi.select(
        "messages", "fraud_alerts",
        F.when(F.col("messages") == 0, F.lit(0.0))
         .otherwise(F.round(F.try_divide("fraud_alerts", "messages") * 100, 1)).alias("alert_rate_pct"),
        "active_meters", F.when(F.col("messages") == 0, F.lit(0.0)).otherwise(F.round("_avg", 2)).alias("avg_kwh"),
        "last_event_time", F.date_format("last_event_time", "HH:mm:ss 'UTC'").alias("last_event_label"))
    counts = state.agg(*[F.coalesce(F.sum(F.when(F.col("fraud_severity") == s, F.col("messages"))), F.lit(0)).cast("long").alias(s)
                         for s in SEVERITY_LABELS])
    zones = (state.filter(F.col("location").isNotNull()).groupBy("location")
                  .agg(F.sum("with_meter").alias("events"), F.sum("alerts").alias("alerts")))
    rate = F.try_divide(F.col("alerts").cast("double"), F.col("events")) * 100
    return {"kpi": kpi, "severity": unpivot_sums(counts, list(SEVERITY_LABELS), "severity", "events"),
            "zones": zones.withColumn("risk_rate", F.bround(rate, 1))}
