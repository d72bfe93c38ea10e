"""Kafka-shaped ingest.

Every function takes a DataFrame with the Kafka source columns
(``key, value, topic, partition, offset, timestamp``), batch or streaming, so
the same code runs on a live topic, on a table of captured records, or on a
file stream in tests.  ``read_kafka_stream`` is the only function that needs
the Kafka connector on the classpath.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from meterlens.config import (
    FRAUD_LABEL, LIVE_MAX_MESSAGES, OK_LABEL, TOPIC, WATERMARK_DELAY,
)
from meterlens.functions.rules import to_number
from meterlens.plans.barrier import materialize
from meterlens.plans.joins import checkpointed, join_small
from meterlens.schema import NUMBERS, PAYLOAD_FIELDS, READING_SCHEMA, READING_TEXT_SCHEMA


#: Closes the wrapped payload in ``is_json_object``; a payload that holds it is dropped.
_END = "end_of_payload_7f3a"
_JSON = {"allowSingleQuotes": "false"}


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = TOPIC,
                      starting_offsets: str = "latest", **options) -> DataFrame:
    """Subscribe to ``topic``; ``failOnDataLoss=false`` as in the reference."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", "false"))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str = TOPIC,
                     starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of a topic (e.g. with per-partition JSON offsets)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load())


def starting_offsets(begin: dict[int, int], end: dict[int, int], topic: str = TOPIC,
                     max_messages: int = LIVE_MAX_MESSAGES) -> str:
    """``startingOffsets`` JSON for ``read_kafka_batch``: per partition the last
    ``max_messages // P + 1`` offsets between its begin and end."""
    per = max(1, max_messages // max(1, len(end)) + 1)
    return json.dumps({topic: {str(p): max(begin.get(p, 0), e - per) for p, e in sorted(end.items())}})


def parse_readings(kafka: DataFrame, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """Decode JSON payloads with the declared schema (raw-zone rows).

    Columns: ``kafka_key``, the 11 payload fields, ``kafka_timestamp``,
    ``event_time``.  A payload that is not a JSON object becomes an all-null
    row (it is kept, as in the stream job); an unparsable timestamp gives a
    null event time instead of failing the batch.  The watermark is set on
    streaming input only (it is a no-op for map-only queries anyway).
    """
    df = materialize(kafka, [], {
        "kafka_key": F.col("key").cast("string"),
        "data": F.from_json(F.col("value").cast("string"), READING_SCHEMA),
        "kafka_timestamp": F.col("timestamp"),
    }).select("kafka_key", *[F.col(f"data.{c}").alias(c) for c in PAYLOAD_FIELDS], "kafka_timestamp")
    df = df.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))
    if watermark and df.isStreaming:
        df = df.withWatermark("event_time", watermark)
    return df


def decode_valid(kafka: DataFrame, keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Tolerant decode for the live view: keep only values that are UTF-8
    text holding a JSON object; every field is kept as text so that one
    badly typed field does not void the others (coercion is ``score_live``'s
    job).  ``keep`` carries Kafka position columns for ordering."""
    keep = [c for c in keep if c in kafka.columns]
    # the fields leave a generator, so no later filter repeats the parse
    return _objects(kafka, keep).select(*keep, F.inline(F.array(F.from_json("_text", READING_TEXT_SCHEMA, _JSON))))


def decode_live(kafka: DataFrame, keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """``decode_valid`` for scoring: the six numbers arrive as doubles.

    A JSON number is read as a double by the one parse; a missing, null or
    quoted one (``"3.5"``) is looked up again as text and converted as
    ``score_live`` converts text.  All other fields are text.
    """
    keep = [c for c in keep if c in kafka.columns]
    schema = StructType([StructField(f.name, DoubleType() if f.name in NUMBERS else f.dataType) for f in READING_TEXT_SCHEMA])
    df = _objects(kafka, keep).select(*keep, "_text", F.inline(F.array(F.from_json("_text", schema, _JSON))))
    def again(c: str) -> Column:
        return F.transform(F.array(F.get_json_object("_text", f"$.{c}")), to_number)[0]
    df = materialize(df, [*keep, *[c for c in PAYLOAD_FIELDS if c not in NUMBERS]],
                     {c: F.coalesce(c, again(c)) for c in NUMBERS})
    return df.select(*keep, *PAYLOAD_FIELDS)


def _objects(kafka: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``_text`` of the records whose value is UTF-8 text holding one
    JSON object.  The value may be computed itself, so it is taken once."""
    df = materialize(kafka, keep, {"_text": F.col("value").cast("string")})
    text = F.col("_text")
    return df.filter(F.is_valid_utf8(text) & ~F.contains(text, F.lit(_END)) & is_json_object(text))


def is_json_object(value: Column) -> Column:
    """Whether ``value`` is one JSON object and nothing else.

    The text becomes the first of two array elements, so that trailing text, a second
    object or a closing bracket leaves something else than the mark in the
    second place.  A VARIANT parse answers at once for nearly all texts.  It
    refuses NaN, Infinity and repeated names, which Python's json accepts;
    only texts it refuses are judged by a second, lenient parse.
    """
    wrapped = F.concat(F.lit("["), value, F.lit(f',{{"{_END}":"1"}}]'))
    marked = F.try_variant_get(F.try_parse_json(wrapped), f"$[1].{_END}", "string")
    pair = F.from_json(wrapped, ArrayType(StructType([StructField(_END, StringType())])), _JSON)
    lenient = (F.size(pair) == 2) & pair[0].isNotNull() & pair[1][_END].isNotNull()
    return (F.substring(F.ltrim(value, F.lit(" \t\n\r")), 1, 1) == "{") & F.coalesce(F.when(marked.isNotNull(), True), lenient, F.lit(False))


def latest_messages(kafka: DataFrame, max_messages: int = LIVE_MAX_MESSAGES) -> DataFrame:
    """The live window: per partition the last ``max_messages // P + 1``
    offsets (P = partitions present), then the newest ``max_messages`` by
    broker time (ties: higher offset, lower partition).

    Per-partition ends are a tiny aggregate joined back with a size-checked
    broadcast; the rest is a filter and a bounded top-k, so no task holds a
    whole partition.  The lowest start offset is a literal filter as well, which
    reaches the scan of a captured topic and skips its older row groups.  On a live topic the same start offsets would be passed
    as ``startingOffsets`` to ``read_kafka_batch`` (see ``starting_offsets``).
    """
    keys = [c for c in ("topic", "partition") if c in kafka.columns]
    ends = (kafka.groupBy(*keys)
                 .agg(F.min("offset").alias("_begin"), (F.max("offset") + 1).alias("_end")))
    n_parts = F.count(F.lit(1)).over(Window.partitionBy())
    ends = ends.withColumn("_per", F.greatest(F.lit(1), F.lit(max_messages) / n_parts + 1)
                           .cast("long"))
    ends = ends.withColumn("_start", F.greatest("_begin", F.col("_end") - F.col("_per")))
    ends = checkpointed(ends.select(*keys, "_start"))
    lowest = ends.agg(F.min("_start")).first()[0]
    if lowest is not None:
        kafka = kafka.filter(F.col("offset") >= F.lit(lowest))
    j = join_small(kafka, ends, keys)
    j = j.filter(F.col("offset") >= F.col("_start")).drop("_start")
    return (j.orderBy(F.desc_nulls_last("timestamp"), F.desc("offset"), F.asc("partition"))
             .limit(max_messages))


def _fmt(pattern: str, c: str):
    return F.when(F.col(c).isNotNull(), F.format_string(pattern, F.col(c)))


def topic_feed(kafka: DataFrame) -> DataFrame:
    """One line per message: label, partition, offset, meter, kWh (%.3f),
    voltage (%.1f) and the payload timestamp."""
    d = F.from_json(F.col("value").cast("string"), READING_SCHEMA)
    df = kafka.select("partition", "offset", d.alias("d"))
    return df.select(
        F.when(F.coalesce(F.col("d._injected_fraud"), F.lit(False)), F.lit(FRAUD_LABEL))
         .otherwise(F.lit(OK_LABEL)).alias("label"),
        "partition", "offset",
        F.col("d.meter_id").alias("meter_id"),
        _fmt("%.3f", "d.consumption_kwh").alias("kwh"),
        _fmt("%.1f", "d.voltage_v").alias("voltage"),
        F.col("d.timestamp").alias("timestamp"))


def topic_partition_stats(kafka: DataFrame) -> DataFrame:
    """Partitions of each topic with first/next offset and message count."""
    return (kafka.groupBy("topic", "partition").agg(
                F.min("offset").alias("begin_offset"),
                (F.max("offset") + 1).alias("end_offset"),
                F.count(F.lit(1)).alias("messages"))
              .orderBy("topic", "partition"))


def committed_offsets(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``topic, partition, committed``: the next offset to read of each
    partition, from the newest batch that a stream's checkpoint has committed.

    The offset log's line ``source`` (after its version and its metadata) is
    the Kafka source's JSON of topics and partitions.  No rows before the first commit.
    """
    log = spark.read.text(f"{checkpoint.rstrip('/')}/commits", wholetext=True).select(_batch_id()).agg(F.max("batch"))
    newest = log.first()[0]
    schema = "topic string, partition int, committed long"
    if newest is None:
        return spark.createDataFrame([], schema)
    text = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{newest}", wholetext=True)
    line = F.split("value", "\n")[2 + source]
    topics = text.select(F.explode(F.from_json(line, "map<string,map<string,bigint>>")).alias("topic", "at"))
    return topics.select("topic", F.explode("at").alias("partition", "committed")).select(
        "topic", F.col("partition").cast("int").alias("partition"), "committed")


def _batch_id() -> Column:
    name = F.col("_metadata.file_name")
    return F.when(name.rlike("^[0-9]+$"), name.cast("long")).alias("batch")


def consumer_lag(kafka: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition of the topic: begin, end, the stream's committed offset
    and how many messages it has yet to read (all of a partition it has not
    seen; those behind the beginning are gone and do not count)."""
    ends = topic_partition_stats(kafka).select("topic", "partition", "begin_offset", "end_offset")
    at = F.greatest("begin_offset", F.coalesce("committed", F.lit(0)))
    return (join_small(ends, committed, ["topic", "partition"], "left")
            .withColumn("lag", F.greatest(F.lit(0).cast("long"), F.col("end_offset") - at))
            .select("topic", "partition", "begin_offset", "end_offset", "committed", "lag").orderBy("topic", "partition"))
