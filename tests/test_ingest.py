from __future__ import annotations

import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fieldpulse.functions.topics import topic_level, topic_matches
from fieldpulse.operators import ingest, quality

ALL_NULL = {"device_id": None, "value": None, "timestamp": None}

PARSE_CASES = [
    ('{"device_id":"a"', ALL_NULL),
    ("hello", ALL_NULL),
    ("[1]", ALL_NULL),
    ("null", ALL_NULL),
    ("5", ALL_NULL),
    ("", ALL_NULL),
    (None, ALL_NULL),
    ("{}", ALL_NULL),
    ('{"device_id":"a","value":"1.5"}', {"device_id": "a", "value": None}),
    ('{"device_id":"a","timestamp":"yesterday"}', {"device_id": "a", "timestamp": None}),
    ('{"device_id":7}', {"device_id": "7"}),
    ('{"device_id":"a","device_id":"b"}', {"device_id": "b"}),
    ('{"Device_Id":"a"}', {"device_id": None}),
    ('{"device_id":"a","other":[1,{"x":2}]}', {"device_id": "a"}),
]


def _messages(spark, texts, topic="sensors/x/y"):
    rows = [(i, None if t is None else bytearray(t.encode()), topic) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "n INT, value BINARY, topic STRING")


def test_parse_table(spark):
    parsed = ingest.parse_readings(
        _messages(spark, [text for text, _ in PARSE_CASES]), keep=["n"]
    ).orderBy("n").collect()
    assert len(parsed) == len(PARSE_CASES)
    for row, (text, expected) in zip(parsed, PARSE_CASES):
        for name, value in expected.items():
            assert row[name] == value, (text, name)


def test_parse_nan_infinity_and_timestamps(spark):
    texts = [
        '{"value":NaN}', '{"value":Infinity}',
        '{"timestamp":"2024-01-01T10:00:00+02:00"}',
        '{"timestamp":"2024-01-01T10:00:00.123456+00:00"}',
        '{"timestamp":1704103200}',
    ]
    parsed = ingest.parse_readings(_messages(spark, texts), keep=["n"]).select(
        "value", F.unix_micros("timestamp").alias("us")
    ).collect()
    assert parsed[0].value != parsed[0].value and parsed[1].value == float("inf")
    assert [row.us for row in parsed[2:]] == [
        1704096000000000, 1704103200123456, 1704103200000000,
    ]


def test_each_message_is_parsed_once(spark):
    clean = quality.clean_readings(ingest.parse_readings(_messages(spark, ["{}"])))
    physical = plan_of(clean).split("== Physical Plan ==")[1]
    assert physical.count("from_json(") == 1


def test_malformed_exactly_when_not_an_object(spark):
    texts = [text for text, _ in PARSE_CASES] + ['{"unknown":1}', '{"value":NaN}']
    classified = quality.classify_messages(_messages(spark, texts), keep=["n"])
    bad = {row.n for row in classified.filter("reject_reason = 'malformed'").collect()}
    assert bad == set(range(7))


def test_invalid_utf8_is_malformed(spark):
    df = spark.createDataFrame(
        [(bytearray(b'{"device_id":"a\xff"}'), "t")], "value BINARY, topic STRING"
    )
    assert quality.classify_messages(df).first().reject_reason == "malformed"
    assert ingest.enrich_topic(df).count() == 0


def test_topic_is_written_into_the_object(spark):
    texts = [
        '{"device_id":"a","extra":{"x":[1,"2"]},"n":1.50,"unit":null}',
        ' {"mqtt_topic":"old","device_id":"a","n":5,"s":"5"} \n',
        "{}", "{ }",
        '{"inner":{"mqtt_topic":"keep"}}',
        '{"text":"}"}',
    ]
    rows = ingest.keyed_records(ingest.enrich_topic(_messages(spark, texts))).collect()
    assert {row.key for row in rows} == {"sensors/x/y"}
    got = [json.loads(row.value) for row in rows]
    topic = {"mqtt_topic": "sensors/x/y"}
    assert got == [
        {"device_id": "a", "extra": {"x": [1, "2"]}, "n": 1.5, "unit": None, **topic},
        {"device_id": "a", "n": 5, "s": "5", **topic},
        topic, topic,
        {"inner": {"mqtt_topic": "keep"}, **topic},
        {"text": "}", **topic},
    ]
    assert '"n":1.50' in rows[0].value


@pytest.mark.parametrize("text", [
    '{"a":1', "x", "[1]", '[{"a":1}', "null", "5", "", None, '{"a":1} x', '{"a":1}{"b":2}',
    '{"a":1}}', "{'a':1}", '{"a":1,}',
])
def test_what_is_not_one_object_is_not_forwarded(spark, text):
    assert ingest.enrich_topic(_messages(spark, [text])).count() == 0


def test_json_round_trip_keeps_microseconds(spark, readings):
    original = readings({"timestamp": "2024-01-01 10:00:00.123456", "unit": None})
    text = original.select(ingest.readings_to_json(original))
    assert "unit" not in text.first().value
    assert ingest.parse_readings(text).collect() == original.drop("ingest_time").collect()


@pytest.mark.parametrize("pattern, matching", [
    ("sensors/#", {"sensors", "sensors/", "sensors/a", "sensors/a/b"}),
    ("sensors/+", {"sensors/", "sensors/a"}),
    ("sensors/+/b", {"sensors/a/b"}),
    ("+/a", {"sensors/a"}),
    ("sensors/a", {"sensors/a"}),
    ("#", {"sensors", "sensors/", "sensors/a", "sensors/a/b", "sensorsx/a/c"}),
])
def test_topic_patterns(spark, pattern, matching):
    topics = ["sensors", "sensors/", "sensors/a", "sensors/a/b", "sensorsx/a/c", "$SYS/a", None]
    df = spark.createDataFrame([(t,) for t in topics], "topic STRING")
    assert {r.topic for r in ingest.filter_topics(df, pattern).collect()} == matching


def test_topic_pattern_errors():
    for pattern in ("a/#/b", "a/b#", "a+/b"):
        with pytest.raises(ValueError):
            topic_matches(None, pattern)


def test_topic_levels(spark):
    row = spark.createDataFrame([("sensors/temperature/d1",)], "t STRING").select(
        topic_level(F.col("t"), 1), topic_level(F.col("t"), 2), topic_level(F.col("t"), 3)
    ).first()
    assert tuple(row) == ("temperature", "d1", None)


def test_prefix_pattern_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([("sensors/a",)], "topic STRING").write.parquet(path)
    plan = plan_of(ingest.filter_topics(spark.read.parquet(path), "sensors/#"))
    assert "StringStartsWith(topic,sensors/)" in plan


@pytest.mark.parametrize("sent, forwarded", [
    ('{"value":NaN,"mqtt_topic":"x"}', '{"value":NaN,"mqtt_topic":"sensors/x/y"}'),
    ('{"mqtt_topic":"x","value":1.50,"n":1e3}', '{"value":1.50,"n":1e3,"mqtt_topic":"sensors/x/y"}'),
    ('{"a":"\\u00e9" , "mqtt_topic" : "q\\"u,}" , "b":007.0}', None),
    ('{"a":1.0,"mqtt_topic":"q\\"u, }"}', '{"a":1.0,"mqtt_topic":"sensors/x/y"}'),
    ('{"mqtt_topic":"only"}', '{"mqtt_topic":"sensors/x/y"}'),
    ('{"note":"say \\"mqtt_topic\\": \\"x\\"","v":2.50}', '{"note":"say \\"mqtt_topic\\": \\"x\\"","v":2.50,"mqtt_topic":"sensors/x/y"}'),
    ('{"inner":{"mqtt_topic":"keep"},"v":2.50}', None),
])
def test_other_fields_keep_their_exact_text(spark, sent, forwarded):
    row = spark.createDataFrame([(sent.encode(), "sensors/x/y")], "value binary, topic string")
    found = [r.value for r in ingest.enrich_topic(row).collect()]
    if forwarded is None:
        assert all(json.loads(v)["mqtt_topic"] == "sensors/x/y" for v in found)
    else:
        assert found == [forwarded]
