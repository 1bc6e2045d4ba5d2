from __future__ import annotations

import statistics

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fieldpulse.operators import windows

KEYS = ["device_id", "sensor_type", "location"]


def test_window_edges_and_single_reading(readings):
    df = readings(
        {"timestamp": "2024-01-01 10:00:00", "value": 1.0},
        {"timestamp": "2024-01-01 10:04:59.999999", "value": 2.0},
        {"timestamp": "2024-01-01 10:05:00", "value": 5.00049},
        {"timestamp": None, "value": 9.0},
    )
    rows = windows.window_stats(df).orderBy("window_start").collect()
    assert [(str(r.window_start)[11:], str(r.window_end)[11:], r.reading_count) for r in rows] == [
        ("10:00:00", "10:05:00", 2), ("10:05:00", "10:10:00", 1),
    ]
    assert (rows[0].avg_value, rows[0].min_value, rows[0].max_value) == (1.5, 1.0, 2.0)
    assert rows[0].stddev_value == 0.707
    assert rows[1].stddev_value is None and rows[1].avg_value == 5.0


def test_one_device_in_two_places(readings):
    df = readings({"location": "a"}, {"location": "b"}, {"location": "b"})
    counts = {r.location: r.reading_count for r in windows.window_stats(df).collect()}
    assert counts == {"a": 1, "b": 2}


def test_partial_aggregation_in_a_hash_map(readings):
    plan = plan_of(windows.window_stats(readings({})))
    assert "partial_avg" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_rollup_equals_direct_statistics(spark, offset):
    df = spark.range(2000).select(
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("device_id"),
        F.lit("t").alias("sensor_type"), F.lit("l").alias("location"),
        (F.lit(offset) + F.sin(F.col("id").cast("double")) / 100).alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7).alias("timestamp"),
    )
    rolled = windows.rollup_windows(windows.window_moments(df), "1 hour")
    direct = windows.window_moments(df, "1 hour")
    order = ["window_start", "device_id"]
    for got, want in zip(
        windows.present_moments(rolled, 9).orderBy(*order).collect(),
        windows.present_moments(direct, 9).orderBy(*order).collect(),
        strict=True,
    ):
        assert got.reading_count == want.reading_count
        assert got.avg_value == pytest.approx(want.avg_value, abs=1e-6)
        assert got.stddev_value == pytest.approx(want.stddev_value, rel=1e-4)
        assert 0.006 < got.stddev_value < 0.008  # would be noise from a difference of squares


def test_merge_of_arbitrary_parts(spark):
    values = [((i * 37) % 101) / 7 for i in range(300)]
    df = spark.createDataFrame(
        [(float(v), i * i % 5, i % 2) for i, v in enumerate(values)], "value DOUBLE, part INT, sub INT"
    )
    parts = df.groupBy("part", "sub").agg(
        F.count("*").alias("reading_count"), F.count("value").alias("value_count"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("*")).alias("m2"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
    ).withColumn("all", F.lit(1))
    for via in ([], ["part"]):
        row = windows.present_moments(windows.merge_moments(parts, ["all"], via), 9).first()
        assert row.reading_count == 300
        assert row.avg_value == pytest.approx(statistics.mean(values), abs=1e-8)
        assert row.stddev_value == pytest.approx(statistics.stdev(values), abs=1e-8)
        assert (row.min_value, row.max_value) == (
            pytest.approx(min(values)), pytest.approx(max(values)),
        )


def test_keep_moments(readings):
    moments = windows.window_moments(readings({"value": 1.0}, {"value": 2.0}))
    row = windows.present_moments(moments, keep_moments=True).first()
    assert (row.mean, row.m2) == (1.5, 0.5)


def test_closed_windows(readings):
    stats = windows.window_stats(readings(
        {"timestamp": "2024-01-01 10:00:00"}, {"timestamp": "2024-01-01 10:07:00"},
    ))
    newest = lambda t: F.lit(f"2024-01-01 {t}").cast("timestamp")
    assert windows.closed_windows(stats, newest("10:07:00")).count() == 1
    assert windows.closed_windows(stats, newest("10:06:59.999")).count() == 0


def test_key_sum_rollup(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.5, "x", 2), ("a", 2, -1.0, "w", 1), ("b", 3, 2.0, "y", 1),
         ("b", -3, -2.0, "z", 2), ("c", None, 0.0, "q", 1)],
        "k STRING, n INT, v DOUBLE, note STRING, seq INT",
    )
    by_self = windows.rollup_sum(df.drop("seq"), ["k"])
    assert by_self.columns == ["k", "n", "v", "note"]
    assert [tuple(r) for r in by_self.collect()] == [("a", 3, 0.5, "w")]
    first = windows.rollup_sum(df, ["k"], ["n", "v"], order_by=["seq"]).first()
    assert (first.note, first.seq) == ("w", 1)
    last = windows.rollup_sum(df.withColumn("seq", -F.col("seq")), ["k"], ["n", "v"], ["seq"]).first()
    assert last.note == "x"
    only_sums = windows.rollup_sum(df.select("k", "n"), ["k"]).collect()
    assert [tuple(r) for r in only_sums] == [("a", 3)]


def test_null_values_are_rows_but_no_values(spark, readings):
    rows = readings({"value": 1.0}, {"value": 3.0, "timestamp": "2024-01-01 10:01:00"},
                    {"value": None, "timestamp": "2024-01-01 10:02:00"},
                    {"value": None, "timestamp": "2024-01-01 10:07:00"},
                    {"value": 8.0, "timestamp": "2024-01-01 10:12:00"})
    stats = {str(r.window_start)[11:16]: r for r in windows.window_stats(rows).collect()}
    assert (stats["10:00"].reading_count, stats["10:00"].avg_value, stats["10:00"].stddev_value) == (3, 2.0, 1.414)
    assert (stats["10:05"].reading_count, stats["10:05"].avg_value, stats["10:05"].stddev_value) == (1, None, None)
    (hour,) = windows.present_moments(
        windows.rollup_windows(windows.window_moments(rows), "1 hour")
    ).collect()
    assert (hour.reading_count, hour.avg_value, hour.stddev_value) == (5, 4.0, 3.606)
