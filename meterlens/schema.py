"""Declared schemas: reading payload, Kafka record, zones."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# Payload of one reading, as declared by the reference stream job.
READING_SCHEMA = StructType([
    StructField("meter_id", StringType(), False),
    StructField("location", StringType(), True),
    StructField("timestamp", StringType(), False),
    StructField("date", StringType(), True),
    StructField("hour", IntegerType(), True),
    StructField("consumption_kwh", DoubleType(), False),
    StructField("voltage_v", DoubleType(), True),
    StructField("current_a", DoubleType(), True),
    StructField("power_factor", DoubleType(), True),
    StructField("frequency_hz", DoubleType(), True),
    StructField("_injected_fraud", BooleanType(), True),
])
PAYLOAD_FIELDS = [f.name for f in READING_SCHEMA.fields]

# The numeric fields of live scoring.
NUMBERS = ["consumption_kwh", "voltage_v", "current_a", "frequency_hz", "power_factor", "hour"]

# Same field names, every value kept as text (tolerant live decode).
READING_TEXT_SCHEMA = StructType([StructField(f.name, StringType(), True)
                                  for f in READING_SCHEMA.fields])

# Columns of a Kafka source row.
KAFKA_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

RAW_EXTRA = [
    StructField("kafka_key", StringType(), True),
    StructField("kafka_timestamp", TimestampType(), True),
    StructField("event_time", TimestampType(), True),
]

FEATURE_FIELDS = [
    StructField("computed_power_w", DoubleType(), True),
    StructField("expected_power_w", DoubleType(), True),
    StructField("power_ratio", DoubleType(), True),
    StructField("is_night_hour", IntegerType(), True),
    StructField("day_of_week", IntegerType(), True),
    StructField("week_of_year", IntegerType(), True),
    StructField("processing_time", TimestampType(), True),
]
RULE_FIELDS = [
    StructField("rule_low_consumption", BooleanType(), True),
    StructField("rule_voltage_spike", BooleanType(), True),
    StructField("rule_power_inconsistency", BooleanType(), True),
    StructField("rule_odd_hour_spike", BooleanType(), True),
    StructField("rule_frequency_anomaly", BooleanType(), True),
    StructField("is_fraud_flagged", BooleanType(), True),
    StructField("rules_fired_count", IntegerType(), True),
    StructField("fraud_severity", StringType(), True),
]

RAW_ZONE_SCHEMA = StructType([StructField("kafka_key", StringType(), True)]
                             + READING_SCHEMA.fields
                             + RAW_EXTRA[1:])
PROCESSED_ZONE_SCHEMA = StructType(RAW_ZONE_SCHEMA.fields + FEATURE_FIELDS + RULE_FIELDS)

RAW_PARTITIONS = ("date", "meter_id")
PROCESSED_PARTITIONS = ("date", "meter_id")
ALERT_PARTITIONS = ("date",)


def ddl(schema: StructType, partitions: tuple[str, ...]) -> str:
    """Column list for ``CREATE TABLE``; partition columns go last."""
    cols = [f for f in schema.fields if f.name not in partitions]
    cols += [f for p in partitions for f in schema.fields if f.name == p]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
