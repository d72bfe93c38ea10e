"""Readings derived from the driver's ``events`` table.

The test data has no smart-meter table, so readings are a deterministic
projection of ``events`` (one reading per event).  The mapping is the one in
FIXTURES.md: it avoids rounding ties and threshold equality, keeps
``event_id`` as a tie-breaker and exercises nulls in voltage and frequency.
The projection is narrow and column-pruned, so it reads only
``event_id, ts, user_id, event_type, value`` from parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.config import TOPIC
from meterlens.schema import PAYLOAD_FIELDS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _zone(meter_no: Column) -> Column:
    return (F.when(meter_no < 2, "Zone_A").when(meter_no < 4, "Zone_B")
             .when(meter_no < 6, "Zone_C").when(meter_no < 8, "Zone_D")
             .otherwise("Zone_E"))


def readings_from_events(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Raw-zone shaped readings: payload + kafka_key/kafka_timestamp/event_time.

    ``event_time`` stays ``timestamp_ntz`` (UTC wall clock) as in the source;
    ``stream_ready`` converts it before any watermark.
    """
    eid = F.col("event_id")
    meter_no = F.col("user_id") % 10
    volt = (F.lit(226) + eid % 21)
    df = events.select(
        F.concat(F.lit("MTR_"), F.lpad((meter_no + 1).cast("string"), 3, "0")).alias("meter_id"),
        _zone(meter_no).alias("location"),
        F.date_format("ts", ISO_FORMAT).alias("timestamp"),
        F.col("ts").cast("date").cast("string").alias("date"),
        F.hour("ts").cast("int").alias("hour"),
        (F.col("value") / 10).alias("consumption_kwh"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
         .otherwise(volt.cast("double")).alias("voltage_v"),
        ((F.col("value") * 100 / volt)
         * F.when(eid % 20 == 0, F.lit(40)).otherwise(F.lit(1))).alias("current_a"),
        F.expr("CAST(0.85 + (event_id % 16) * 0.01 AS DOUBLE)").alias("power_factor"),
        F.when(eid % 89 == 0, F.lit(None).cast("double"))
         .otherwise(F.expr("CAST(49.775 + (event_id % 46) * 0.01 AS DOUBLE)")).alias("frequency_hz"),
        (F.col("event_type") == "error").alias("_injected_fraud"),
        F.col("ts").alias("event_time"),
        eid.alias("event_id"),
        *[F.col(c) for c in extra],
    )
    return (df.withColumn("kafka_key", F.col("meter_id"))
              .withColumn("kafka_timestamp", F.col("event_time")))


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events").select(*EVENT_COLUMNS))


def kafka_records_from_readings(rd: DataFrame) -> DataFrame:
    """Wrap readings as Kafka source rows: JSON payload in ``value``.

    Needs ``partition`` and ``offset`` columns on ``rd``.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in PAYLOAD_FIELDS]))
    return rd.select(
        F.col("meter_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.try_to_timestamp(F.col("timestamp")).alias("timestamp"),
    )


def kafka_records(spark: SparkSession, sf_dir: str, partitions: int = 3) -> DataFrame:
    """Kafka-shaped rows of the readings: event ids are dealt to the partitions
    in turn, so each partition's offsets are dense."""
    ev = load_table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    ev = ev.withColumns({"partition": (F.col("event_id") % partitions).cast("int"),
                         "offset": F.floor(F.col("event_id") / partitions)})
    return kafka_records_from_readings(readings_from_events(ev, extra=("partition", "offset")))
