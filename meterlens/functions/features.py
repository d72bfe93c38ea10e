"""Derived electrical and calendar features (map-only, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.config import DEFAULT_THRESHOLDS, Thresholds


def power_columns(th: Thresholds = DEFAULT_THRESHOLDS, rounded: bool = True):
    """(computed_power_w, expected_power_w, power_ratio) expressions.

    ``expected = kWh * 30 * 1000`` keeps the left-to-right association of
    the reference so the last bit of the double does not change.
    """
    computed = F.col("voltage_v") * F.col("current_a")
    expected = F.col("consumption_kwh") * th.interval_per_hour * 1000
    if rounded:
        computed, expected = F.round(computed, 3), F.round(expected, 3)
    return computed, expected


def add_features(df: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Add computed/expected power, ratio, night flag, calendar fields.

    ``day_of_week`` is Spark's ``dayofweek``: 1 = Sunday.  ``week_of_year``
    is the ISO week.  ``processing_time`` is constant within a micro-batch.
    """
    computed, expected = power_columns(th)
    df = df.withColumns({"computed_power_w": computed, "expected_power_w": expected})
    return df.withColumns({
        "power_ratio": F.when(
            F.col("expected_power_w") > 0,
            F.round(F.col("computed_power_w") / F.col("expected_power_w"), 4),
        ).otherwise(F.lit(None).cast("double")),
        "is_night_hour": F.col("hour").between(th.night_hour_start, th.night_hour_end).cast("int"),
        "day_of_week": F.dayofweek("event_time"),
        "week_of_year": F.weekofyear("event_time"),
        "processing_time": F.current_timestamp(),
    })
