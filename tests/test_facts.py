"""Numbers established for the derived fixture at sf0.01 (FIXTURES.md)."""

from pyspark.sql import functions as F

from meterlens.config import RULE_COLUMNS
from meterlens.operators.baseline import ROLLING_RULES, apply_rolling_rules
from meterlens.operators.outliers import q4_2_iqr
from meterlens.operators.timeseries import q3_2_day_change
from meterlens.queries import meter_features, raw_readings
from tests.conftest import SF01


def test_rule_fire_counts(spark):
    mf = meter_features(spark, SF01)
    row = mf.agg(*[F.count_if(F.col(r)).alias(r) for r in RULE_COLUMNS],
                 F.count_if("is_fraud_flagged").alias("flagged")).first()
    assert [row[r] for r in RULE_COLUMNS] == [572, 471, 494, 915, 1289]
    assert row.flagged == 3290


def test_severity_flag_counts(spark):
    mf = meter_features(spark, SF01)
    got = {(r.fraud_severity, r.is_fraud_flagged): r["count"]
           for r in mf.groupBy("fraud_severity", "is_fraud_flagged").count().collect()}
    assert got == {("HIGH", True): 24, ("MEDIUM", True): 402, ("LOW", True): 2834,
                   ("NONE", False): 6636, ("NONE", True): 30, ("NONE", None): 74}


def test_zscore_population(spark):
    raw = raw_readings(spark, SF01)
    s = raw.groupBy("meter_id").agg(F.avg("consumption_kwh").alias("m"),
                                    F.stddev_pop("consumption_kwh").alias("s"))
    n = raw.join(s, "meter_id").filter(F.abs((F.col("consumption_kwh") - F.col("m")) / F.col("s")) > 2).count()
    assert n == 494


def test_iqr_rows(spark):
    assert q4_2_iqr(raw_readings(spark, SF01)).count() == 467


def test_day_change_rows(spark):
    assert q3_2_day_change(raw_readings(spark, SF01)).count() == 60


def test_rolling_rule_counts(spark):
    out = apply_rolling_rules(raw_readings(spark, SF01))
    row = out.agg(*[F.count_if(F.col(r)).alias(r) for r in ROLLING_RULES]).first()
    assert [row[r] for r in ROLLING_RULES] == [826, 977, 378]
