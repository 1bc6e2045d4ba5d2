from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fieldpulse.operators.latest import latest_version
from fieldpulse.operators.state import device_current, merge_states, partial_states


def test_greatest_version_wins(readings):
    df = readings(
        {"value": 1.0, "ingest_time": "2024-01-02 00:00:01"},
        {"value": 2.0, "ingest_time": "2024-01-02 00:00:03"},
        {"value": 3.0, "ingest_time": "2024-01-02 00:00:02"},
        {"value": 4.0, "device_id": "d2"},
    )
    kept = latest_version(df)
    assert kept.columns == df.columns
    assert sorted(r.value for r in kept.collect()) == [2.0, 4.0]


def test_seconds_collapse_only_when_asked(readings):
    df = readings(
        {"timestamp": "2024-01-01 10:00:00.100", "value": 1.0},
        {"timestamp": "2024-01-01 10:00:00.900", "value": 2.0, "ingest_time": "2024-01-03 00:00:00"},
    )
    assert latest_version(df).count() == 2
    (row,) = latest_version(df, whole_seconds=True).collect()
    assert row.value == 2.0 and row.timestamp.microsecond == 0


def test_equal_versions_do_not_depend_on_row_order(readings):
    rows = [{"value": 1.0}, {"value": 2.0}, {"value": 1.5}]
    answers = {latest_version(readings(*order)).first().value for order in (rows, rows[::-1])}
    assert answers == {2.0}


def test_copies_are_reduced_before_the_shuffle(readings):
    assert "partial_max" in plan_of(latest_version(readings({})))


def _many(spark):
    return spark.range(500).select(
        F.concat(F.lit("d"), (F.col("id") % 4).cast("string")).alias("device_id"),
        F.lit("t").alias("sensor_type"),
        F.when(F.col("id") % 8 < 4, "here").otherwise("there").alias("location"),
        (F.col("id") * 31 % 97).cast("double").alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 13 % 50).alias("timestamp"),
        F.timestamp_seconds(F.lit(1704153600) + F.col("id") * 7 % 3).alias("ingest_time"),
    )


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_merged_partials_equal_one_pass(spark, parts):
    df = _many(spark)
    whole = device_current(partial_states(df, 0)).collect()
    split = device_current(partial_states(df, F.pmod(F.xxhash64("value"), F.lit(parts)))).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split))
    assert sum(r.total_readings for r in whole) == 500
    expected = df.groupBy("device_id", "sensor_type", "location").agg(
        F.max_by("value", F.struct("timestamp", "ingest_time", "value")), F.max("timestamp"),
        F.max("value"), F.min("value"), F.count("*"),
    ).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, expected))


def test_merging_twice_changes_nothing(spark):
    once = merge_states(partial_states(_many(spark), 0))
    assert sorted(map(str, merge_states(once).collect())) == sorted(map(str, once.collect()))


def test_location_stays_in_the_key(readings):
    df = readings({"location": "a"}, {"location": "b"})
    assert device_current(partial_states(df, 1)).count() == 2
