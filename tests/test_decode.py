"""Payload decoding: strict stream decode vs tolerant live decode."""

from pyspark.sql import functions as F

from meterlens.sources.kafka import decode_valid, latest_messages, parse_readings, topic_feed

PAYLOADS = [
    b"{bad", b"[1]", b"5", b"{}",
    b'{"meter_id":"m","consumption_kwh":"abc"}',
    b'{"meter_id":"m","consumption_kwh":"3.5"}',
    b'{"meter_id":"m","consumption_kwh":NaN}',
    b"\x80\xff",
    b'{"meter_id":"m","timestamp":"x","consumption_kwh":1.0}',
    b'{"meter_id":"m","timestamp":"2024-01-02T00:00:00+00:00","consumption_kwh":1.0}',
]


def kafka_frame(spark, payloads):
    rows = [(b"m", p, "energy_readings", 0, i, None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")


def test_parse_keeps_every_message(spark):
    out = parse_readings(kafka_frame(spark, PAYLOADS)).orderBy("kafka_key").collect()
    assert len(out) == len(PAYLOADS)
    by_off = parse_readings(kafka_frame(spark, PAYLOADS)).collect()
    # bad timestamp -> null event time, no failure
    assert by_off[8].event_time is None and by_off[9].event_time is not None
    # wrong-typed field -> null, rest kept
    assert by_off[4].meter_id == "m" and by_off[4].consumption_kwh is None


def test_decode_valid_drops_non_objects(spark):
    out = decode_valid(kafka_frame(spark, PAYLOADS)).orderBy("offset").collect()
    offsets = [r.offset for r in out]
    assert offsets == [3, 4, 5, 6, 8, 9]  # '{}' kept, junk / arrays / scalars / bad utf-8 dropped
    assert out[2].consumption_kwh == "3.5"  # numeric text kept as text
    assert out[1].consumption_kwh == "abc"


def test_topic_feed_labels(spark):
    payloads = [b'{"meter_id":"m","consumption_kwh":1.23456,"voltage_v":230.04,"_injected_fraud":true}',
                b'{"meter_id":"m","consumption_kwh":1.0,"_injected_fraud":false}']
    rows = topic_feed(kafka_frame(spark, payloads)).orderBy("offset").collect()
    assert rows[0].label.endswith("FRAUD") and rows[0].kwh == "1.235" and rows[0].voltage == "230.0"
    assert rows[1].label == "OK" and rows[1].voltage is None


def test_latest_messages_per_partition_window(spark):
    rows = [(b"m", b"{}", "t", p, o, None) for p in range(3) for o in range(100)]
    df = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    out = latest_messages(df, max_messages=30).collect()
    assert len(out) == 30
    # per partition at most 30 // 3 + 1 = 11 newest offsets are candidates
    assert min(r.offset for r in out) >= 89
    out = latest_messages(df.filter(F.col("partition") == 0), max_messages=5).collect()
    assert sorted(r.offset for r in out) == [95, 96, 97, 98, 99]
