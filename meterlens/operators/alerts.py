"""Section 5: flagged-reading analysis and the console alert feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.config import SEVERITY_LABELS
from meterlens.operators.overview import label_at, label_order

ALERT_FEED_COLUMNS = [
    "meter_id", "timestamp", "location", "consumption_kwh", "voltage_v", "fraud_severity",
    "rule_low_consumption", "rule_voltage_spike", "rule_power_inconsistency",
    "rule_odd_hour_spike",
]


def flagged(mf: DataFrame) -> DataFrame:
    """``is_fraud_flagged = TRUE`` (null flags are not alerts)."""
    return mf.filter(F.col("is_fraud_flagged"))


def alert_feed(mf: DataFrame) -> DataFrame:
    """Flagged rows, the ten columns mirrored to the console."""
    return flagged(mf).select(*ALERT_FEED_COLUMNS)


def q5_1_suspicious_meters(mf: DataFrame) -> DataFrame:
    day = F.col("date").try_cast("date")  # dates aggregate by hash, strings would sort
    return (flagged(mf).groupBy("meter_id", "location").agg(
                F.count(F.lit(1)).alias("alert_count"),
                F.sum("rules_fired_count").alias("total_rules_fired"),
                F.round(F.avg("rules_fired_count"), 2).alias("avg_rules_per_alert"),
                F.max(label_order(F.col("fraud_severity"))).alias("_max"),
                F.min(day).alias("_first"), F.max(day).alias("_last"))
              .select("meter_id", "location", "alert_count", "total_rules_fired", "avg_rules_per_alert",
                      label_at(F.col("_max")).alias("max_severity"),
                      F.col("_first").cast("string").alias("first_alert_date"),
                      F.col("_last").cast("string").alias("last_alert_date"))
              .orderBy(F.desc("alert_count"), "meter_id", "location"))


def q5_2_alert_hours(mf: DataFrame) -> DataFrame:
    return (flagged(mf).groupBy("hour").agg(
                F.count(F.lit(1)).alias("alert_count"),
                F.round(F.avg("consumption_kwh"), 3).alias("avg_kwh_at_alert"),
                F.round(F.avg("voltage_v"), 2).alias("avg_voltage_at_alert"))
              .orderBy("hour"))


def q5_3_severity_share(mf: DataFrame) -> DataFrame:
    """Count and share of each severity among flagged readings.

    The share's ``OVER ()`` window runs on the aggregated rows (at most one
    per label), so its single partition holds a handful of rows.
    """
    counts = flagged(mf).groupBy("fraud_severity").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    order = F.lit(4)
    for i, label in enumerate(reversed(SEVERITY_LABELS[1:])):  # HIGH, MEDIUM, LOW
        order = F.when(F.col("fraud_severity") == label, F.lit(i + 1)).otherwise(order)
    return (counts.withColumn("pct", F.round(F.col("count") * 100.0 / total, 2))
                  .orderBy(order, "fraud_severity"))
