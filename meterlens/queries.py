"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (``events``) through
``sources.events`` and runs the library operator on all of it.  Timestamps
leaving a query are UTC wall-clock ``timestamp_ntz`` so results do not
depend on the session time zone; ``processing_time`` (wall clock of the run)
is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions.features import add_features
from meterlens.functions.rules import apply_rules, score_live, utc_wallclock
from meterlens.operators import alerts, baseline, live, outliers, overview, rule_stats, summary, timeseries
from meterlens.sources import events, kafka
from meterlens.streaming.rollups import rollups_of, stream_minute_state

Query = Callable[[SparkSession, str], DataFrame]


def meter_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed zone: readings -> features -> rules."""
    return apply_rules(add_features(events.readings(spark, sf_dir)))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.readings(spark, sf_dir)


def live_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records -> tolerant decode -> live scoring."""
    return score_live(kafka.decode_live(events.kafka_records(spark, sf_dir)))


def _mf(op) -> Query:
    return lambda spark, sf: op(meter_features(spark, sf))


def _raw(op) -> Query:
    return lambda spark, sf: op(raw_readings(spark, sf))


def _live(op) -> Query:
    return lambda spark, sf: op(live_scored(spark, sf))


def _summary(op) -> Query:
    return lambda spark, sf: op(summary.report_summary(meter_features(spark, sf)))


def _frame(name: str) -> Query:
    return lambda spark, sf: summary.report_frames(meter_features(spark, sf))[name]


def _lag(spark, sf):
    """A reader that has stopped a half, a third, ... of the way through the partitions."""
    topic = events.kafka_records(spark, sf)
    done = (topic.groupBy("topic", "partition")
                 .agg(F.expr("min(offset) + (max(offset) - min(offset)) div (partition + 2)").alias("committed")))
    return kafka.consumer_lag(topic, done)


def _minute_state(part: str) -> Query:
    return lambda spark, sf: rollups_of(stream_minute_state(live_scored(spark, sf)))[part]


def _features(spark, sf):
    return add_features(raw_readings(spark, sf)).drop("processing_time")


def _rules(spark, sf):
    return meter_features(spark, sf).drop("processing_time")


def _parse(spark, sf):
    df = kafka.parse_readings(events.kafka_records(spark, sf))
    return df.withColumns({"kafka_timestamp": utc_wallclock(F.col("kafka_timestamp")),
                           "event_time": utc_wallclock(F.col("event_time"))})


def _latest(spark, sf):
    k = kafka.latest_messages(events.kafka_records(spark, sf))
    return k.select("partition", "offset", F.col("key").cast("string").alias("kafka_key"),
                    utc_wallclock(F.col("timestamp")).alias("kafka_timestamp"))


def _rolling(spark, sf):
    return baseline.rolling_baseline(raw_readings(spark, sf)).select(
        "meter_id", "event_id", "timestamp", "consumption_kwh", "rolling_mean_kwh", "rolling_count")


def _rolling_rules(spark, sf):
    return baseline.apply_rolling_rules(raw_readings(spark, sf)).select(
        "meter_id", "event_id", "timestamp", "hour", "consumption_kwh", "rolling_mean_kwh",
        *baseline.ROLLING_RULES)


def _imbalance(spark, sf):
    return baseline.rule_current_imbalance(raw_readings(spark, sf)).select(
        "meter_id", "event_id", "timestamp", "consumption_kwh", "voltage_v", "current_a",
        "rule_current_imbalance")


QUERIES: dict[str, Query] = {
    # sources / decode
    "parse_readings": _parse,
    "decode_valid": lambda spark, sf: kafka.decode_valid(events.kafka_records(spark, sf)),
    "latest_messages": _latest,
    "topic_feed": lambda spark, sf: kafka.topic_feed(events.kafka_records(spark, sf)),
    "topic_partition_stats": lambda spark, sf: kafka.topic_partition_stats(events.kafka_records(spark, sf)),
    "consumer_lag": _lag,
    # features / rules
    "add_features": _features,
    "apply_rules": _rules,
    "alert_feed": _mf(alerts.alert_feed),
    "score_live": lambda spark, sf: live_scored(spark, sf),
    # live KPIs
    "kpi_live": _live(live.kpi_live),
    "timeline_minute": _live(live.timeline_minute),
    "severity_mix": _live(live.severity_mix),
    "zone_risk": _live(live.zone_risk),
    "recent_readings": _live(live.recent_readings),
    "latest_alerts": _live(live.latest_alerts),
    "live_window": lambda spark, sf: live.live_window(events.kafka_records(spark, sf)),
    "kpi_live_window": lambda spark, sf: live.kpi_live(live.live_window(events.kafka_records(spark, sf))),
    "minute_state_severity": _minute_state("severity"),
    "minute_state_zones": _minute_state("zones"),
    # batch analytics
    "q1_1_daily_overview": _mf(overview.q1_1_daily_overview),
    "q1_2_meter_overview": _mf(overview.q1_2_meter_overview),
    "q2_1_rule_fires": _mf(rule_stats.q2_1_rule_fires),
    "q2_2_cooccurrence": _mf(rule_stats.q2_2_cooccurrence),
    "q3_1_hourly_profile": _mf(timeseries.q3_1_hourly_profile),
    "q3_2_day_change": _raw(timeseries.q3_2_day_change),
    "q3_2_day_change_true": _raw(timeseries.q3_2_day_change_true),
    "q3_3_weekly_baseline": _mf(timeseries.q3_3_weekly_baseline),
    "q3_3_weekly_baseline_by_year": _mf(lambda mf: timeseries.q3_3_weekly_baseline(mf, by_year=True)),
    "q4_1_zscore": _raw(outliers.q4_1_zscore),
    "q4_2_iqr": _raw(outliers.q4_2_iqr),
    "q4_2_iqr_exact": _raw(lambda rd: outliers.q4_2_iqr(rd, exact=True)),
    "q4_2_iqr_interpolated": _raw(lambda rd: outliers.q4_2_iqr(rd, interpolate=True)),
    "q5_1_suspicious_meters": _mf(alerts.q5_1_suspicious_meters),
    "q5_2_alert_hours": _mf(alerts.q5_2_alert_hours),
    "q5_3_severity_share": _mf(alerts.q5_3_severity_share),
    "q6_master_summary": _mf(summary.q6_master_summary),
    "q6_master_summary_exact": _mf(lambda mf: summary.q6_master_summary(mf, exact=True)),
    # report
    "report_summary": _mf(summary.report_summary),
    "report_hourly": _mf(summary.report_hourly),
    "report_daily_trend": _mf(summary.report_daily_trend),
    "report_severity": _mf(summary.report_severity),
    "report_frame_summary": _frame("summary"),
    "report_frame_hourly": _frame("hourly"),
    "report_frame_daily_trend": _frame("daily_trend"),
    "report_frame_severity": _frame("severity"),
    "meter_risk_band": _summary(summary.meter_risk_band),
    "rule_totals": _summary(summary.rule_totals),
    "fleet_totals": _summary(summary.fleet_totals),
    "meter_table": _summary(summary.meter_table),
    # baselines and evaluation
    "rolling_baseline": _rolling,
    "apply_rolling_rules": _rolling_rules,
    "rule_current_imbalance": _imbalance,
    "rule_evaluation": _mf(baseline.rule_evaluation),
    "weekly_expected_range": _mf(baseline.weekly_expected_range),
}
