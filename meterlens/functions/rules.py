"""Fraud rules: stream scoring (three-valued) and live scoring (null-safe)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.config import DEFAULT_THRESHOLDS, RULE_COLUMNS, Thresholds
from meterlens.functions.features import power_columns
from meterlens.plans.barrier import materialize
from meterlens.schema import NUMBERS


def severity(count: Column) -> Column:
    return (F.when(count >= 3, F.lit("HIGH"))
             .when(count == 2, F.lit("MEDIUM"))
             .when(count == 1, F.lit("LOW"))
             .otherwise(F.lit("NONE")))


def rule_predicates(th: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, Column]:
    """The five static rules over the columns produced by ``add_features``."""
    return {
        "rule_low_consumption": F.col("consumption_kwh") < th.low_consumption_kwh,
        "rule_voltage_spike": F.col("voltage_v") > th.voltage_max_v,
        "rule_power_inconsistency": F.col("power_ratio").isNotNull()
            & (F.col("power_ratio") > th.power_ratio_max),
        "rule_odd_hour_spike": (F.col("is_night_hour") == 1)
            & (F.col("consumption_kwh") > th.night_consumption_kwh),
        "rule_frequency_anomaly": F.col("frequency_hz").isNotNull()
            & ~F.col("frequency_hz").between(th.freq_min_hz, th.freq_max_hz),
    }


def apply_rules(df: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
                nulls: str = "reference") -> DataFrame:
    """Score every reading with the five rules, flag, count and severity.

    ``nulls="reference"`` keeps SQL three-valued logic exactly as the stream
    job does: a null input makes its rule null, the flag is null unless some
    rule is true, and the count is null if any rule is null (so a flagged
    row with one null rule has severity NONE).  ``nulls="false"`` treats an
    unknown rule as not fired, which is the live dashboard's count policy.
    """
    preds = rule_predicates(th)
    if nulls == "false":
        preds = {k: F.coalesce(v, F.lit(False)) for k, v in preds.items()}
    elif nulls != "reference":
        raise ValueError("nulls must be 'reference' or 'false'")
    df = df.withColumns(preds)
    rules = [F.col(c) for c in RULE_COLUMNS]
    df = df.withColumns({
        "is_fraud_flagged": reduce(lambda a, b: a | b, rules),
        "rules_fired_count": reduce(lambda a, b: a + b, [r.cast("int") for r in rules]),
    })
    return df.withColumn("fraud_severity", severity(F.col("rules_fired_count")))


def to_number(text: Column) -> Column:
    """Text -> double, bad text or NaN -> null (pandas ``to_numeric`` coerce)."""
    v = text.try_cast("double")
    last = F.lower(F.substring(F.rtrim(text), -1, 1))
    # a JVM parse would also take suffixes ("3.5d", "3.5f") and hexadecimal ("0x1p3")
    odd = (last == "d") | ((last == "f") & ~F.lower(F.rtrim(text)).endswith("inf")) | F.contains(F.lower(text), F.lit("x"))
    return F.when(v.isNotNull() & ~F.isnan(v) & ~odd, v)


def utc_wallclock(ts: Column) -> Column:
    """Instant -> ``timestamp_ntz`` holding its UTC wall clock.

    Independent of the session time zone, so results compare equal on any
    cluster setting.
    """
    return F.to_utc_timestamp(ts, F.current_timezone()).cast("timestamp_ntz")


def utc_event_time(text: Column) -> Column:
    """Text -> UTC wall clock; text without an offset is UTC already, whatever
    the session's time zone is."""
    # the usual form is a UTC wall clock already; all others are told apart by pattern
    usual = text.endswith("+00:00") & (F.substring(text, 5, 1) == "-") & (F.substring(text, 11, 1) == "T")
    has_offset = text.rlike(r"(Z|[+-]\d{1,2}(:?\d{2})?|UTC|GMT)\s*$") & text.rlike(r"\d:\d")
    return (F.when(usual, text.substr(F.lit(1), F.length(text) - 6).try_cast("timestamp_ntz"))
             .when(has_offset, utc_wallclock(F.try_to_timestamp(text)))
             .otherwise(text.try_cast("timestamp_ntz")))


def score_live(df: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
               ordered: bool = False) -> DataFrame:
    """Dashboard scoring of decoded readings (text or typed columns).

    Differs from ``apply_rules`` on purpose, like the dashboard does: power
    features are not rounded, unknown inputs make rules 1-4 false, a missing
    frequency *fires* rule 5, the count is null-safe, the flag is
    ``count > 0``, ``hour`` falls back to the UTC hour of the event time and
    ``minute`` is the event time floored to the minute.
    """
    cols = set(df.columns)
    def text(c):
        return F.col(c).cast("string") if c in cols else F.lit(None).cast("string")
    # Parsed once, behind a generator: a filter on a score must not repeat it.  Numbers that
    # are text share one lambda, as six copies make a method that the JVM doesn't compile.
    given = df.columns
    kinds = dict(df.dtypes)
    typed = [c for c in NUMBERS if kinds.get(c) in ("double", "float", "int", "bigint")]
    worded = [c for c in NUMBERS if c not in typed]
    parsed = {"_injected_fraud": text("_injected_fraud").try_cast("boolean"), "event_time": utc_event_time(text("timestamp"))}
    if worded:
        parsed["_numbers"] = F.transform(F.array(*[text(c) for c in worded]), to_number)
    df = materialize(df, [c for c in given if c not in {*worded, *parsed}], parsed)
    df = df.withColumns({**{c: F.col("_numbers")[i] for i, c in enumerate(worded)},
                         **{c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in typed}})
    computed, expected = power_columns(th, rounded=False)
    df = df.withColumns({
        "hour": F.coalesce("hour", F.hour("event_time").cast("double")),
        "computed_power_w": computed,
        "expected_power_w": expected,
    })
    df = df.withColumn(
        "power_ratio",
        F.col("computed_power_w") / F.when(F.col("expected_power_w") > 0, F.col("expected_power_w")))
    false = F.lit(False)
    df = df.withColumns({
        "rule_low_consumption": F.coalesce(F.col("consumption_kwh") < th.low_consumption_kwh, false),
        "rule_voltage_spike": F.coalesce(F.col("voltage_v") > th.voltage_max_v, false),
        "rule_power_inconsistency": F.coalesce(F.col("power_ratio") > th.power_ratio_max, false),
        "rule_odd_hour_spike": F.coalesce(
            F.col("hour").between(th.night_hour_start, th.night_hour_end)
            & (F.col("consumption_kwh") > th.night_consumption_kwh), false),
        "rule_frequency_anomaly": ~F.coalesce(
            F.col("frequency_hz").between(th.freq_min_hz, th.freq_max_hz), false),
    })
    count = reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in RULE_COLUMNS])
    df = df.withColumn("rules_fired_count", count)
    df = df.withColumns({
        "is_fraud_flagged": F.col("rules_fired_count") > 0,
        "fraud_severity": severity(F.col("rules_fired_count")),
        "minute": F.date_trunc("minute", F.col("event_time")).cast("timestamp_ntz"),
    })
    df = df.select(*given, *[c for c in df.columns if c not in cols and c != "_numbers"])
    if ordered:
        df = df.orderBy(F.asc_nulls_last("event_time"))
    return df


def rolling_rule_predicates(mean: Column, th: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, Column]:
    """Ratio rules against a per-meter rolling mean (null mean -> null)."""
    kwh = F.col("consumption_kwh")
    return {
        "rule_low_vs_baseline": kwh < mean * th.low_consumption_ratio,
        "rule_spike_vs_baseline": kwh > mean * th.spike_ratio,
        "rule_night_vs_baseline": F.col("hour").between(th.night_hour_start, th.night_hour_end)
            & (kwh > mean * th.night_multiplier),
    }


def current_imbalance(th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """V*I against kWh*1000*1.15 (the header's rule 3, without the x30)."""
    return (F.col("current_a") * F.col("voltage_v")
            > F.col("consumption_kwh") * 1000 * th.current_imbalance_ratio)
