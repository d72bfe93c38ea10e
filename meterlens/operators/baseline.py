"""Rolling baselines and rule evaluation (documented in the reference's
text but not executed there; semantics are ours and stated per function)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.config import DEFAULT_THRESHOLDS, RULE_COLUMNS, Thresholds
from meterlens.functions.rules import current_imbalance, rolling_rule_predicates
from meterlens.plans.joins import join_small
from meterlens.plans.windows import preceding_range_agg

ROLLING_RULES = ("rule_low_vs_baseline", "rule_spike_vs_baseline", "rule_night_vs_baseline")


def rolling_baseline(raw: DataFrame, window: str = "30 minutes", bucket: str = "6 hours",
                     keep_exact: bool = False) -> DataFrame:
    """Per meter, mean kWh of the readings in the preceding ``window``
    (``[t - window, t)``: the current row and same-instant rows excluded).

    Adds ``rolling_mean_kwh`` (6 dp; null without history) and
    ``rolling_count``.  NaN and infinite readings are missing ones, as null is:
    not counted, not averaged.  Rows without a time get null in both.  Runs on (meter, time-bucket) partitions, see
    ``plans.windows``: no task ever holds a whole meter.
    """
    kwh = F.when(F.abs("consumption_kwh") < float("inf"), F.col("consumption_kwh"))
    out = preceding_range_agg(
        raw, "meter_id", "event_time", {"_mean": F.avg(kwh), "rolling_count": F.count(kwh)},
        window=window, bucket=bucket)
    out = out.withColumn("rolling_mean_kwh", F.round("_mean", 6))
    return out if keep_exact else out.drop("_mean")


def apply_rolling_rules(raw: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
                        window: str = "30 minutes", bucket: str = "6 hours") -> DataFrame:
    """The header's ratio rules against the rolling mean: low (< 0.20 x),
    spike (> 3.5 x), night (hour 0-5 and > 2.0 x).  A null mean gives null."""
    out = rolling_baseline(raw, window, bucket, keep_exact=True)
    out = out.withColumns(rolling_rule_predicates(F.col("_mean"), th)).drop("_mean")
    return out


def rule_current_imbalance(raw: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Adds ``rule_current_imbalance``: V x I > kWh x 1000 x 1.15."""
    return raw.withColumn("rule_current_imbalance", current_imbalance(th))


def rule_evaluation(mf: DataFrame, label: str = "_injected_fraud") -> DataFrame:
    """Confusion counts, precision and recall of each rule and of the flag
    against the injected-fraud label.  An unknown (null) rule counts as not
    fired; rows with a null label are left out.  One aggregate pass."""
    preds = list(RULE_COLUMNS) + ["is_fraud_flagged"]
    y = F.col(label)
    base = mf.filter(y.isNotNull())
    cells = []
    for p in preds:
        hit = F.coalesce(F.col(p), F.lit(False))
        cells += [F.count_if(hit & y).alias(f"{p}__tp"), F.count_if(hit & ~y).alias(f"{p}__fp"),
                  F.count_if(~hit & y).alias(f"{p}__fn"), F.count_if(~hit & ~y).alias(f"{p}__tn")]
    sums = base.agg(*cells)
    rows = ", ".join(f"'{p}', `{p}__tp`, `{p}__fp`, `{p}__fn`, `{p}__tn`" for p in preds)
    out = sums.selectExpr(f"stack({len(preds)}, {rows}) AS (rule_name, tp, fp, fn, tn)")
    return out.select(
        "rule_name", "tp", "fp", "fn", "tn",
        F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), 4).alias("precision"),
        F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), 4).alias("recall"))


def weekly_expected_range(mf: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Readings outside their meter-week mean +/- 3 population std.

    The meter-week statistics table has meters x weeks rows and is joined
    with ``join_small`` (broadcast only within a proven bound).
    """
    stats = mf.groupBy("meter_id", "week_of_year").agg(
        F.avg("consumption_kwh").alias("_mean"), F.stddev_pop("consumption_kwh").alias("_std"))
    j = join_small(mf.select("meter_id", "week_of_year", "timestamp", "consumption_kwh"),
                   stats, ["meter_id", "week_of_year"])
    lo = F.col("_mean") - th.weekly_sigma * F.col("_std")
    hi = F.col("_mean") + th.weekly_sigma * F.col("_std")
    kwh = F.col("consumption_kwh")
    j = j.filter((kwh < lo) | (kwh > hi))
    return (j.select(
                "meter_id", "week_of_year", "timestamp", "consumption_kwh",
                F.round("_mean", 4).alias("weekly_avg_kwh"),
                F.round("_std", 4).alias("weekly_stddev_kwh"),
                F.round(lo, 4).alias("lower_bound"), F.round(hi, 4).alias("upper_bound"),
                F.when(kwh < lo, "BELOW_WEEKLY_RANGE").otherwise("ABOVE_WEEKLY_RANGE").alias("range_anomaly_type"))
              .repartition("meter_id", "timestamp").orderBy("meter_id", "timestamp", "consumption_kwh"))


__all__ = ["rolling_baseline", "apply_rolling_rules", "rule_current_imbalance",
           "rule_evaluation", "weekly_expected_range", "ROLLING_RULES"]
