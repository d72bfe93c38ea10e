"""Section 1: daily and per-meter overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.config import SEVERITY_LABELS


def flag_int(c: str = "is_fraud_flagged") -> Column:
    return F.col(c).cast("int")


def rate_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """``round(part * 100 / whole, scale)`` as a double."""
    return F.round(part * 100.0 / whole, scale)


def severity_rank(c: Column) -> Column:
    """NONE < LOW < MEDIUM < HIGH as 0..3 (null for any other label)."""
    expr = F.lit(None).cast("int")
    for i, label in enumerate(SEVERITY_LABELS):
        expr = F.when(c == label, F.lit(i)).otherwise(expr)
    return expr


def rank_to_severity(c: Column) -> Column:
    expr = F.lit(None).cast("string")
    for i, label in enumerate(SEVERITY_LABELS):
        expr = F.when(c == i, F.lit(label)).otherwise(expr)
    return expr


#: Labels in string order: their numbers aggregate by hash, strings would sort.
_BY_TEXT = sorted(SEVERITY_LABELS)


def label_order(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array_position(F.lit(_BY_TEXT), c).cast("int"))


def label_at(n: Column) -> Column:
    return F.when(n > 0, F.element_at(F.lit(_BY_TEXT), n))


def q1_1_daily_overview(mf: DataFrame) -> DataFrame:
    """Readings, flags and flag rate per day, newest day first."""
    out = mf.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.sum(flag_int()).alias("fraud_count"),
    )
    return (out.withColumn("fraud_rate_pct", rate_pct(F.col("fraud_count"), F.col("total_readings")))
               .orderBy(F.desc("date")))


def q1_2_meter_overview(mf: DataFrame) -> DataFrame:
    """Per meter and location: volume, flags, mean kWh and V, severity.

    ``max_severity`` is the reference's string maximum (lexicographic:
    NONE > MEDIUM > LOW > HIGH); ``worst_severity`` ranks the labels.
    """
    out = mf.groupBy("meter_id", "location").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.sum(flag_int()).alias("fraud_flags"),
        F.round(F.avg("consumption_kwh"), 3).alias("avg_kwh"),
        F.round(F.avg("voltage_v"), 2).alias("avg_voltage"),
        F.max(label_order(F.col("fraud_severity"))).alias("_max"),
        F.max(severity_rank(F.col("fraud_severity"))).alias("_worst"),
    )
    out = (out.withColumn("max_severity", label_at(F.col("_max")))
              .withColumn("worst_severity", rank_to_severity(F.col("_worst"))).drop("_max", "_worst"))
    return out.orderBy(F.desc("fraud_flags"), "meter_id", "location")
