"""Section 6 master summary and the report's queries / post-aggregations.

P5-P8 are second-level aggregates over the per-meter summary; they stay in
the same plan, so only a final small result ever leaves the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.config import DEFAULT_THRESHOLDS, RISK_BANDS, RULE_COLUMNS, Thresholds
from meterlens.operators.overview import flag_int, rate_pct
from meterlens.operators.quantiles import exact_quantiles, group_key
from meterlens.operators.rule_stats import unpivot_sums
from meterlens.plans.joins import checkpointed, join_small

RULE_FIRE_COLUMNS = [f"rule{i + 1}_fires" for i in range(len(RULE_COLUMNS))]


def _meter_summary(mf: DataFrame, distribution: bool, accuracy: int = 10000) -> DataFrame:
    kwh = F.col("consumption_kwh")
    aggs = [
        F.count(F.lit(1)).alias("total_readings"),
        F.sum(flag_int()).alias("fraud_flag_count"),
        F.round(F.avg(kwh), 4).alias("avg_kwh"),
        F.round(F.stddev_pop(kwh), 4).alias("stddev_kwh"),
    ]
    if distribution:
        aggs += [F.round(F.min(kwh), 4).alias("min_kwh"),
                 F.round(F.max(kwh), 4).alias("max_kwh"),
                 F.round(F.percentile_approx(kwh, 0.5, accuracy), 4).alias("median_kwh")]
    aggs += [F.round(F.avg("voltage_v"), 2).alias("avg_voltage"),
             F.round(F.max("voltage_v"), 2).alias("max_voltage")]
    aggs += [F.sum(F.col(r).cast("int")).alias(n) for r, n in zip(RULE_COLUMNS, RULE_FIRE_COLUMNS)]
    aggs += [F.sum(F.when(F.col("fraud_severity") == s, 1).otherwise(0)).alias(f"{s.lower()}_alerts")
             for s in ("HIGH", "MEDIUM", "LOW")]
    out = mf.groupBy("meter_id", "location").agg(*aggs)
    out = out.withColumn("fraud_rate_pct", rate_pct(F.col("fraud_flag_count"), F.col("total_readings")))
    order = ["meter_id", "location", "total_readings", "fraud_flag_count", "fraud_rate_pct",
             "avg_kwh", "stddev_kwh"]
    if distribution:
        order += ["min_kwh", "max_kwh", "median_kwh"]
    order += ["avg_voltage", "max_voltage", *RULE_FIRE_COLUMNS,
              "high_alerts", "medium_alerts", "low_alerts"]
    return out.select(*order).orderBy(F.desc("fraud_flag_count"), "meter_id", "location")


def q6_master_summary(mf: DataFrame, accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """Per meter: volume, flag rate, kWh distribution, voltage, rules, severity.
    The median comes from a sketch, or with ``exact`` from ``operators.quantiles``."""
    out = _meter_summary(mf, True, accuracy)
    if not exact:
        return out
    keys = ["meter_id", "location"]
    median = exact_quantiles(mf, keys, "consumption_kwh", [0.5], accuracy)
    return (join_small(out.withColumn("_key", group_key(keys)), median, "_key", "left")
            .withColumn("median_kwh", F.round(F.col("q")[0], 4)).select(out.columns)
            .orderBy(F.desc("fraud_flag_count"), *keys))


def report_summary(mf: DataFrame) -> DataFrame:
    """The report's master summary: Q6 without min/max/median kWh."""
    return _meter_summary(mf, False)


def report_hourly(mf: DataFrame) -> DataFrame:
    return (mf.groupBy("hour").agg(
                F.round(F.avg("consumption_kwh"), 4).alias("avg_kwh"),
                F.sum(flag_int()).alias("fraud_count"))
              .orderBy("hour"))


def report_daily_trend(mf: DataFrame) -> DataFrame:
    return (mf.groupBy(F.col("date").alias("event_date")).agg(
                F.round(F.avg("consumption_kwh"), 4).alias("daily_avg_kwh"),
                F.sum(flag_int()).alias("daily_fraud_count"))
              .orderBy("event_date"))


def report_severity(mf: DataFrame) -> DataFrame:
    return (mf.filter(F.col("is_fraud_flagged"))
              .groupBy("fraud_severity").agg(F.count(F.lit(1)).alias("count")))


def report_frames(mf: DataFrame) -> dict[str, DataFrame]:
    """``summary``, ``hourly``, ``daily_trend`` and ``severity`` of the report from
    one scan: grouping sets over the four keys, combined before one shuffle,
    and the few rows left kept in a checkpoint that the frames read."""
    groups = ["meter_id", "location", "hour", "date", "fraud_severity"]
    kwh = F.col("consumption_kwh")
    names = {(0, 1): "summary", (2,): "hourly", (3,): "daily_trend", (4,): "severity"}
    aggs = [F.count(F.lit(1)).alias("total_readings"), F.sum(flag_int()).alias("fraud_flag_count"),
            F.avg(kwh).alias("_avg"), F.stddev_pop(kwh).alias("_std"), F.avg("voltage_v").alias("_volt"),
            F.max("voltage_v").alias("_max_volt"), F.count_if("is_fraud_flagged").alias("_flagged"),
            *[F.sum(F.col(r).cast("int")).alias(n) for r, n in zip(RULE_COLUMNS, RULE_FIRE_COLUMNS)],
            *[F.sum(F.when(F.col("fraud_severity") == s, 1).otherwise(0)).alias(f"{s.lower()}_alerts")
              for s in ("HIGH", "MEDIUM", "LOW")]]
    # the grouped columns are copies: within a grouping set the others read as null
    keyed = mf.withColumns({f"_g{i}": F.col(c) for i, c in enumerate(groups)})
    sets = [[F.col(f"_g{i}") for i in key] for key in names]
    all_rows = checkpointed(keyed.groupingSets(sets, *[F.col(f"_g{i}") for i in range(len(groups))])
                                 .agg(F.grouping_id().alias("_set"), *aggs))

    def part(key: tuple) -> DataFrame:
        absent = sum(1 << (len(groups) - 1 - i) for i in range(len(groups)) if i not in key)
        return all_rows.filter(F.col("_set") == absent).withColumnsRenamed({f"_g{i}": groups[i] for i in key})

    whole = (part((0, 1)).withColumns({"avg_kwh": F.round("_avg", 4), "stddev_kwh": F.round("_std", 4),
                                       "avg_voltage": F.round("_volt", 2), "max_voltage": F.round("_max_volt", 2),
                                       "fraud_rate_pct": rate_pct(F.col("fraud_flag_count"), F.col("total_readings"))})
             .select("meter_id", "location", "total_readings", "fraud_flag_count", "fraud_rate_pct", "avg_kwh", "stddev_kwh",
                     "avg_voltage", "max_voltage", *RULE_FIRE_COLUMNS, "high_alerts", "medium_alerts", "low_alerts")
             .orderBy(F.desc("fraud_flag_count"), "meter_id", "location"))
    hourly = part((2,)).select("hour", F.round("_avg", 4).alias("avg_kwh"), F.col("fraud_flag_count").alias("fraud_count")).orderBy("hour")
    daily = part((3,)).select(F.col("date").alias("event_date"), F.round("_avg", 4).alias("daily_avg_kwh"),
                              F.col("fraud_flag_count").alias("daily_fraud_count")).orderBy("event_date")
    severity = part((4,)).filter("_flagged > 0").select("fraud_severity", F.col("_flagged").alias("count"))
    return {"summary": whole, "hourly": hourly, "daily_trend": daily, "severity": severity}


def meter_risk_band(summary: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Colour band per meter: rate > 30 red, > 10 orange, else green."""
    rate = F.col("fraud_rate_pct")
    band = (F.when(rate > th.risk_red_pct, RISK_BANDS[0])
             .when(rate > th.risk_orange_pct, RISK_BANDS[1])
             .otherwise(RISK_BANDS[2]))
    return summary.select("meter_id", "location", "fraud_rate_pct", band.alias("risk_band"))


def rule_totals(summary: DataFrame) -> DataFrame:
    """Fires of each rule summed over all meters (one row per rule)."""
    sums = summary.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(r)
                         for c, r in zip(RULE_FIRE_COLUMNS, RULE_COLUMNS)])
    return unpivot_sums(sums, list(RULE_COLUMNS), "rule_name", "total_fires")


def fleet_totals(summary: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Fleet-wide totals printed by the report (0 % when there is no data)."""
    total = F.coalesce(F.sum("total_readings"), F.lit(0)).cast("long")
    fraud = F.coalesce(F.sum("fraud_flag_count"), F.lit(0)).cast("long")
    out = summary.agg(
        total.alias("total_readings"),
        fraud.alias("total_fraud"),
        F.count(F.lit(1)).alias("meters_monitored"),
        F.count_if(F.col("fraud_rate_pct") > th.risk_red_pct).alias("meters_over_30pct"))
    pct = F.when(F.col("total_readings") > 0,
                 F.round(F.col("total_fraud") * 100.0 / F.col("total_readings"), 2)).otherwise(F.lit(0.0))
    return out.select("total_readings", "total_fraud", pct.alias("overall_fraud_pct"),
                      "meters_monitored", "meters_over_30pct")


def meter_table(summary: DataFrame) -> DataFrame:
    """The report's four-column meter table, in summary order."""
    return (summary.select("meter_id", "fraud_rate_pct", "avg_kwh", "fraud_flag_count")
                   .orderBy(F.desc("fraud_flag_count"), "meter_id"))
