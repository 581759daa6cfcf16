"""Payload cases (FIXTURES.md §2) through the real decode job."""

import json

import pytest
from pyspark.sql import functions as F

from clickrate.operators.parse import INVALID_EVENT, MALFORMED_JSON, parse_payloads

BASE = {"event_id": "e-77", "event_type": "view", "product_id": "sku-41", "user_id": "reader-8",
        "timestamp": "2023-07-14 06:30:00"}


def with_(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


OK = "ok"
CASES = [
    # (label, payload, expected outcome, expected timestamp)
    ("1 base", with_(), OK, 1689316200000),
    ("2 number ts", with_(event_type="click", product_id="sku-52", timestamp=1689000000000,
                          session_id="visit-3"), OK, 1689000000000),
    ("3 unknown type", with_(event_type="scroll"), INVALID_EVENT, None),
    ("4 extra field", with_(x=5), OK, 1689316200000),
    ("5a no product", with_(product_id=...), INVALID_EVENT, None),
    ("5b empty product", with_(product_id=""), INVALID_EVENT, None),
    ("5c blank product", with_(product_id=" \t"), INVALID_EVENT, None),
    ("6a upper type", with_(event_type="VIEW"), INVALID_EVENT, None),
    ("6b no type", with_(event_type=...), INVALID_EVENT, None),
    ("7a int string", with_(timestamp="1700000000000"), OK, 1700000000000),
    ("7b negative", with_(timestamp="-5"), OK, -5),
    ("8 iso Z", with_(timestamp="2024-01-01T12:00:00Z"), OK, 1704110400000),
    ("9 iso micros", with_(timestamp="2024-01-01T12:00:00.123456Z"), OK, 1704110400123),
    ("10 iso offset", with_(timestamp="2024-01-01T12:00:00+09:00"), OK, 1704078000000),
    ("11a empty ts", with_(timestamp=""), INVALID_EVENT, None),
    ("11b padded", with_(timestamp=" 5"), INVALID_EVENT, None),
    ("11c date only", with_(timestamp="2024-01-01"), INVALID_EVENT, None),
    ("11d no zone", with_(timestamp="2024-01-01T12:00:00"), INVALID_EVENT, None),
    ("11e word", with_(timestamp="tomorrow"), INVALID_EVENT, None),
    ("12a float", with_(timestamp=1.7e12), INVALID_EVENT, None),
    ("12b bool", with_(timestamp=True), INVALID_EVENT, None),
    ("12c null", with_(timestamp=None), INVALID_EVENT, None),
    ("12d missing", with_(timestamp=...), INVALID_EVENT, None),
    ("13 huge number", with_(timestamp=...)[:-1] + ', "timestamp": 99999999999999999999}', MALFORMED_JSON, None),
    # smart resolution of the wall-clock shape (reference clamps / rolls over)
    ("14a feb 30", with_(timestamp="2024-02-30 12:00:00"), OK, 1709208000000),
    ("14b hour 24", with_(timestamp="2024-01-01 24:00:00"), OK, 1704153600000),
    ("14c minute 60", with_(timestamp="2024-01-01 12:60:00"), INVALID_EVENT, None),
    ("15 number product", with_(product_id=12), OK, 1689316200000),
    ("16a object product", with_(product_id={"a": 1}), MALFORMED_JSON, None),
    ("16b array type", with_(event_type=["view"]), MALFORMED_JSON, None),
    ("16c brace text", with_(product_id="{x"), OK, 1689316200000),
    ("17a not json", "not json", MALFORMED_JSON, None),
    ("17b empty", "", MALFORMED_JSON, None),
    ("17c array", "[1]", MALFORMED_JSON, None),
    ("18 null doc", "null", INVALID_EVENT, None),
    ("20 trailing", with_() + " trailing", OK, 1689316200000),
    ("single quotes", "{'event_type':'view','product_id':'p','timestamp':1}", MALFORMED_JSON, None),
    ("repeated key", '{"event_type":"x","event_type":"view","product_id":"p","timestamp":1}', OK, 1),
    ("iso leap second", with_(timestamp="2016-12-31T23:59:60Z"), OK, 1483228799000),
    ("iso bad day", with_(timestamp="2024-02-30T12:00:00Z"), INVALID_EVENT, None),
    ("iso lower t", with_(timestamp="2024-01-01t12:00:00z"), OK, 1704110400000),
    ("iso nanos", with_(timestamp="2024-01-01T12:00:00.999999999-01:30"), OK, 1704115800999),
    ("iso year 0", with_(timestamp="0000-01-01T00:00:00Z"), OK, -62167219200000),
    ("wall year 0", with_(timestamp="0000-01-01 00:00:00"), INVALID_EVENT, None),
    ("long float", with_(timestamp=...)[:-1] + ', "timestamp": 1700000000000000000.0}', INVALID_EVENT, None),
    ("40 digit number", with_(timestamp=...)[:-1] + ', "timestamp": ' + "7" * 40 + "}", MALFORMED_JSON, None),
    ("40 digit text", with_(timestamp="7" * 40), INVALID_EVENT, None),
    ("64 bit edge", with_(timestamp=9223372036854775808), MALFORMED_JSON, None),
    ("bracket text", with_(product_id="[x"), OK, 1689316200000),
    ("object user", with_(user_id={}), MALFORMED_JSON, None),
    ("object ts", with_(timestamp={"a": 1}), INVALID_EVENT, None),
    ("iso offset 19h", with_(timestamp="2024-01-01T12:00:00+19:00"), INVALID_EVENT, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(label, "Impression", payload) for label, payload, _, _ in CASES]
    rows.append(("19 tombstone", "Impression", None))
    df = spark.createDataFrame(rows, "label string, source string, value string")
    out = parse_payloads(df).select("label", "error_message", "is_success", "event", "raw")
    return {r["label"]: r for r in out.collect()}


@pytest.mark.parametrize("label,payload,expected,ts", CASES, ids=[c[0] for c in CASES])
def test_payload_case(parsed, label, payload, expected, ts):
    r = parsed[label]
    if expected == OK:
        assert r["is_success"], r["error_message"]
        assert r["event"]["timestamp"] == ts
    else:
        assert not r["is_success"]
        assert r["error_message"] == expected
        assert r["event"] is None
        assert bytes(r["raw"]).decode("utf-8") == payload


def test_number_product_is_text(parsed):
    assert parsed["15 number product"]["event"]["product_id"] == "12"


@pytest.mark.parametrize("token", ["12.50", "1.0", "1e3", "1" * 41, "1" * 40 + "2", "true", "1E+5", "-0.0", "1e400", "0.10"])
def test_text_fields_keep_the_token(spark, token):
    payload = '{"event_type":"click","product_id":%s,"timestamp":5}' % token
    df = spark.createDataFrame([("Click", payload)], "source string, value string")
    assert parse_payloads(df).first()["event"]["product_id"] == token


def test_float_text_in_strings_and_other_fields_is_left_alone(spark):
    payloads = ['{"event_type":"click","user_id":"\\"product_id\\":12.500, \\"product_id","product_id":"12.5","timestamp":5}',
                '{"event_type":"click","product_id":7.250 , "user_id":12.50,"timestamp":5}',
                '{"product_id":"a 1.50","event_type":"click","user_id":"1.0.0","timestamp":5}']
    df = spark.createDataFrame([("Click", p) for p in payloads], "source string, value string")
    got = [(r["event"]["product_id"], r["event"]["user_id"]) for r in parse_payloads(df).collect()]
    assert got == [("12.5", '"product_id":12.500, "product_id'), ("7.250", "12.50"), ("a 1.50", "1.0.0")]


@pytest.mark.parametrize("bad", [b"\xff", b"\xc0\xaf", b"\xed\xa0\x80"])
def test_bytes_that_are_no_utf8_are_dead_letters(spark, bad):
    from clickrate.operators.parse import dead_letters

    payload = b'{"event_type":"click","product_id":"a' + bad + b'","timestamp":5}'
    df = spark.createDataFrame([("Click", bytearray(payload))], "source string, value binary")
    r = dead_letters(parse_payloads(df)).first()
    assert r["error_message"] == MALFORMED_JSON and bytes(r["raw"]) == payload and "\ufffd" in r["line"]


def test_tombstone_goes_to_dlq(parsed):
    r = parsed["19 tombstone"]
    assert not r["is_success"] and r["error_message"] == MALFORMED_JSON


def test_dlq_line_format(spark):
    from clickrate.operators.parse import dead_letters

    df = spark.createDataFrame([("Click", with_(event_type="nope"))], "source string, value string")
    line = dead_letters(parse_payloads(df)).select("line").first()[0]
    assert line == f"DLQ [Click]: Invalid event data, Data: {with_(event_type='nope')}"


def test_binary_values_decode_like_text(spark):
    df = spark.createDataFrame([("Impression", bytearray(with_().encode()))], "source string, value binary")
    r = parse_payloads(df).select("is_success", "event.timestamp").first()
    assert r[0] and r[1] == 1689316200000


def test_parse_plan_decodes_once(spark):
    df = spark.createDataFrame([("Impression", with_())], "source string, value string")
    from clickrate.operators.parse import valid_events

    plan = valid_events(parse_payloads(df)).filter(F.col("event_type") == "view")._jdf \
        .queryExecution().optimizedPlan().toString()
    # one decode of every row, and one type probe that only rows of open type reach
    assert plan.count("from_json(") == 2
    assert plan.count("THEN from_json(") == 1
