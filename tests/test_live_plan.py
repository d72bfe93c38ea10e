"""The live path parses a payload once and scores each reading once."""

import pytest
from pyspark.sql import functions as F

from meterlens.functions.rules import score_live
from meterlens.queries import QUERIES
from meterlens.sources.kafka import decode_live, decode_valid
from tests.conftest import SF001
from tests.test_decode import kafka_frame

LIVE = ["score_live", "kpi_live", "timeline_minute", "severity_mix", "zone_risk", "recent_readings", "latest_alerts"]


@pytest.mark.parametrize("name", LIVE)
def test_one_parse_and_no_pattern_per_number(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 4  # the record; three places in the lenient check of what VARIANT refuses
    assert plan.count("try_parse_json") + plan.count("parseJson") == 1
    assert plan.count("RLIKE") <= 2  # event times of an unusual form only
    assert plan.count("to_utc_timestamp") <= 1


def test_typed_decode_scores_like_text(spark):
    payloads = [b'{"meter_id":"m","timestamp":"2024-01-15T10:00:00+00:00","consumption_kwh":0.1,"voltage_v":230.5,"hour":3}',
                b'{"meter_id":"m","consumption_kwh":"3.5","voltage_v":"abc","current_a":" 2 ","frequency_hz":"3.5d","hour":"7"}',
                b'{"meter_id":"m","consumption_kwh":NaN,"hour":null}', b"{}", b'{"voltage_v":1,"voltage_v":260}',
                b'{"meter_id":{"a":1},"consumption_kwh":true,"voltage_v":[1],"frequency_hz":"inf","power_factor":"0x1p3"}',
                b'{"consumption_kwh":1e300,"voltage_v":1E2,"current_a":123456789012345678901234567890,"frequency_hz":-0.5}',
                b'{"timestamp":"2024-01-15 10:00:00","consumption_kwh":"5f"}', b'{"timestamp":"2024-01-15T10:00:00+02:00"}',
                b'{"timestamp":"2024-01-15T10:00:00.25Z","_injected_fraud":"true"}', b'{"timestamp":1705312800}']
    df = kafka_frame(spark, payloads)
    cols = score_live(decode_valid(df)).columns
    want = score_live(decode_valid(df)).orderBy("offset").collect()
    got = score_live(decode_live(df)).select(cols).orderBy("offset").collect()
    assert len(want) == len(payloads) and [str(r) for r in got] == [str(r) for r in want]
    assert want[1].consumption_kwh == 3.5 and want[1].current_a == 2.0 and want[1].frequency_hz is None and want[1].hour == 7.0
    assert want[4].voltage_v == 260 and want[5].frequency_hz == float("inf") and want[5].power_factor is None
    bare = decode_live(kafka_frame(spark, [b'{"voltage_v":Infinity,"current_a":NaN}'])).first()
    assert bare.voltage_v == float("inf") and bare.current_a != bare.current_a
    assert str(want[0].event_time) == "2024-01-15 10:00:00" and str(want[8].event_time) == "2024-01-15 08:00:00"


def test_filters_on_scores_stay_above_the_parse(spark):
    plan = score_live(decode_live(kafka_frame(spark, [b"{}"]))).filter(F.col("is_fraud_flagged") & (F.col("voltage_v") > 1))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("to_utc_timestamp") <= 1 and text.count("get_json_object") <= 6
