from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import quality
from fieldpulse.schema import PLAUSIBLE_RANGES, ColumnRule


def _edge_rows():
    rows = []
    for kind, (low, high) in PLAUSIBLE_RANGES.items():
        rows += [
            ({"sensor_type": kind, "value": low}, None),
            ({"sensor_type": kind, "value": high}, None),
            ({"sensor_type": kind, "value": math.nextafter(low, -math.inf)}, "out_of_range"),
            ({"sensor_type": kind, "value": math.nextafter(high, math.inf)}, "out_of_range"),
        ]
    return rows + [
        ({"value": float("nan")}, "out_of_range"),
        ({"value": float("inf")}, "out_of_range"),
        ({"value": float("-inf")}, "out_of_range"),
        ({"value": None}, "null_value"),
        ({"quality": "GOOD"}, "bad_quality"),
        ({"quality": None}, "bad_quality"),
        ({"quality": "uncertain", "value": None}, "bad_quality"),
        ({"sensor_type": None}, "unknown_type"),
        ({"sensor_type": "Temperature"}, "unknown_type"),
        ({"sensor_type": "co2", "value": None}, "null_value"),
        ({"device_id": None}, None),
        ({"timestamp": None}, None),
    ]


@pytest.fixture
def edges(readings):
    cases = _edge_rows()
    return readings(*[{**row, "unit": str(i)} for i, (row, _) in enumerate(cases)]), cases


def test_reasons_at_the_edges(edges):
    df, cases = edges
    got = {row.unit: row.reject_reason for row in quality.with_reject_reason(df).collect()}
    assert got == {str(i): reason for i, (_, reason) in enumerate(cases)}


def test_accepted_equals_the_filters_and_the_rules(spark, edges):
    df, _ = edges
    reasoned = quality.with_reject_reason(df)
    ids = lambda d: {row.unit for row in d.collect()}
    kept = ids(quality.clean_readings(df))
    assert ids(quality.accepted(reasoned)) == kept
    assert ids(quality.clean_by_rules(df, quality.range_rules(spark))) == kept
    assert ids(quality.rejected(reasoned)) == ids(df) - kept


def test_rules_longer_than_the_broadcast_limit(spark, edges, monkeypatch):
    df, _ = edges
    monkeypatch.setattr(quality, "BROADCAST_RULE_BYTES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = quality.clean_by_rules(df, quality.range_rules(spark)).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept == quality.clean_readings(df).count()


def test_overlapping_rules_do_not_repeat_rows(spark, readings):
    rules = spark.createDataFrame(
        [("temperature", 0.0, 30.0), ("temperature", 10.0, 40.0)],
        "sensor_type STRING, low DOUBLE, high DOUBLE",
    )
    df = readings({"value": 20.0}, {"value": 35.0}, {"value": 41.0})
    assert quality.clean_by_rules(df, rules).count() == 2


def test_future_clock_only_when_asked(readings):
    df = readings({"timestamp": "2024-01-02 00:10:01"}, {"timestamp": "2024-01-02 00:10:00"})
    assert quality.accepted(quality.with_reject_reason(df)).count() == 2
    guarded = quality.with_reject_reason(df, clock_allowance="10 minutes")
    assert [r.reject_reason for r in guarded.orderBy("timestamp").collect()] == [None, "future_clock"]


def test_contract(readings):
    df = readings(
        {"unit": "ok"},
        {"unit": "u" * 16, "device_id": "d" * 64, "location": None},
        {"unit": "u" * 17, "device_id": "d" * 65},
        {"unit": "n", "timestamp": None, "value": None, "device_id": None},
    )
    assert quality.conforming(df).count() == 2
    assert [r.violations for r in quality.violating(df).orderBy("unit").collect()] == [
        "device_id:null,value:null,timestamp:null", "device_id:length,unit:length",
    ]


def test_contract_counts_characters_not_bytes(readings):
    df = readings({"unit": "°°"})
    assert quality.conforming(df, {"unit": ColumnRule(2)}).count() == 1


def test_classified_messages_keep_payload_and_ingest_time(spark):
    df = spark.createDataFrame([(bytearray(b"junk"),)], "value BINARY")
    row = quality.rejected(quality.classify_messages(df)).first()
    assert row.payload == "junk" and row.ingest_time is not None
    kept = quality.classify_messages(
        df.withColumn("ingest_time", F.lit("2024-01-01").cast("timestamp")), keep=["ingest_time"]
    ).first()
    assert kept.ingest_time.year == 2024
