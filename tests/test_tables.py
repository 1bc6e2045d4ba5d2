from __future__ import annotations

import glob
import os
from datetime import datetime, timezone

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fieldpulse.plans import catalog
from fieldpulse.session import clear_scratch, scratch_path, written
from fieldpulse.sources import batches, tables


def _values(df):
    return sorted(r.value for r in df.collect())


def test_batches_append_and_a_retry_replaces(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(readings({"value": 1.0}), path, 0)
    tables.append_readings(readings({"value": 2.0, "device_id": "d2"}), path, 1)
    tables.append_readings(readings({"value": 2.0, "device_id": "d2"}), path, 1)
    assert _values(batches.read_batches(spark, path, tables.READINGS_TABLE_DDL)) == [1.0, 2.0]
    assert tables.read_readings(spark, str(tmp_path / "none")).count() == 0


def test_reading_gives_the_latest_version_across_batches(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for batch, second in enumerate((2, 3, 1)):
        tables.append_readings(
            readings({"value": float(second), "ingest_time": f"2024-01-02 00:00:0{second}"}),
            path, batch,
        )
    assert _values(tables.read_readings(spark, path)) == [3.0]
    assert tables.settle_readings(spark, path, upto=2) == 2
    assert len(os.listdir(f"{path}/fresh")) == 3
    assert _values(tables.read_readings(spark, path)) == [3.0]
    batches.vacuum(spark, path)
    assert glob.glob(f"{path}/fresh/batch_id=*") == []
    assert _values(tables.read_readings(spark, path)) == [3.0]


def test_missing_ingest_time_is_filled(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(readings({"ingest_time": None}), path, 0)
    tables.append_readings(readings({"device_id": "d2"}).drop("ingest_time"), path, 1)
    assert tables.read_readings(spark, path).filter("ingest_time IS NULL").count() == 0


def test_half_written_folders_do_not_count(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(readings({"value": 1.0}), path, 0)
    tables.append_readings(readings({"value": 2.0, "device_id": "d2"}), path, 1)
    tables.settle_readings(spark, path, upto=1)
    os.remove(f"{path}/settled/upto=1/_SUCCESS")
    os.remove(f"{path}/fresh/batch_id=1/_SUCCESS")
    assert _values(tables.read_readings(spark, path)) == [1.0]


def test_last_batch_stays_fresh_and_settled_ones_are_closed(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        tables.append_readings(readings({"device_id": f"d{n}", "value": float(n)}), path, n)
    assert tables.settle_readings(spark, path) == 1
    assert tables.settle_readings(spark, path) is None
    tables.append_readings(readings({"device_id": "d2", "value": 2.0}), path, 2)
    with pytest.raises(ValueError, match="checkpoint reset"):
        tables.append_readings(readings({}), path, 1)
    assert _values(tables.read_readings(spark, path)) == [0.0, 1.0, 2.0]


def test_filters_prune_partitions_below_the_merge(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(
        readings(*[{"timestamp": f"2024-01-{d:02d} 10:00:00"} for d in range(1, 6)]), path, 0
    )
    assert len(glob.glob(f"{path}/fresh/batch_id=0/event_day=*/sensor_type=temperature")) == 5
    some = tables.read_readings(spark, path, "2024-01-03", "2024-01-04").filter(
        "sensor_type = 'temperature'"
    )
    physical = plan_of(some).split("== Physical Plan ==")[1]
    partition_filters = physical.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_day" in partition_filters and "sensor_type" in partition_filters
    assert some.count() == 2


def test_days_are_utc_whatever_the_session_zone(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    late = readings({}).withColumn("timestamp", F.timestamp_micros(F.lit(1704150000000000)))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        tables.append_readings(late, path, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert os.path.isdir(f"{path}/fresh/batch_id=0/event_day=2024-01-01")


def test_retention_drops_whole_days_and_filters_the_boundary(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    stamps = ["2024-01-10 23:00:00", "2024-01-11 11:00:00", "2024-01-11 13:00:00", "2024-01-20 00:00:00"]
    tables.append_readings(
        readings(*[{"timestamp": s, "value": float(i)} for i, s in enumerate(stamps)]), path, 0
    )
    as_of = datetime(2024, 2, 10, 12, tzinfo=timezone.utc)
    assert tables.expire_readings(spark, path, as_of) == 1
    assert _values(tables.read_readings(spark, path)) == [1.0, 2.0, 3.0]
    assert _values(tables.read_retained(spark, path, as_of)) == [2.0, 3.0]


def test_states_merge_count_once_and_outlive_readings(spark, readings, tmp_path):
    path = str(tmp_path / "s")
    for n in range(5):
        batch = readings({"value": float(n), "timestamp": f"2024-01-01 10:00:0{n}"}, {"value": -1.0})
        tables.append_states(batch, path, n)
        tables.append_states(batch, path, n)

    def current():
        (row,) = tables.read_device_current(spark, path).collect()
        return row.current_value, row.max_value, row.min_value, row.total_readings

    expected = (4.0, 4.0, -1.0, 10)
    assert current() == expected
    assert tables.settle_states(spark, path, upto=1) == 1 and current() == expected
    assert tables.settle_states(spark, path) == 3 and current() == expected
    batches.vacuum(spark, path, cumulative=True)
    assert os.listdir(f"{path}/settled") == ["upto=3"] and current() == expected


def test_upkeep_beside_a_stream(spark, readings, tmp_path):
    from fieldpulse.operators.windows import present_moments, window_moments

    root = str(tmp_path)
    for n in range(3):
        batch = readings({"timestamp": f"2024-01-0{n + 1} 10:00:00", "value": float(n)})
        tables.append_readings(batch, f"{root}/readings", n)
        tables.append_states(batch, f"{root}/states", n)
        tables.append_window_stats(
            present_moments(window_moments(batch), keep_moments=True), f"{root}/window_stats", n
        )
    as_of = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for _ in range(2):
        tables.maintain(spark, root, as_of)
        assert _values(tables.read_readings(spark, f"{root}/readings")) == [1.0, 2.0]
        stats = tables.read_window_stats(spark, f"{root}/window_stats", since="2024-01-02")
        assert sorted(r.avg_value for r in stats.collect()) == [1.0, 2.0]
        assert tables.read_device_current(spark, f"{root}/states").first().total_readings == 3
    for name in ("readings", "states", "window_stats"):
        assert batches.settled_marks(spark, f"{root}/{name}") == [1]


def test_clustered_files_cover_separate_ranges(spark, readings, tmp_path):
    path = str(tmp_path / "c")
    df = readings(*[
        {"sensor_type": kind, "timestamp": f"2024-01-{d:02d} 10:00:00"}
        for kind in ("humidity", "temperature") for d in range(1, 11)
    ])
    tables.write_clustered(df, path, files=4)
    ranges = sorted(
        (r.lo, r.hi) for r in spark.read.parquet(path)
        .select(F.struct("sensor_type", "timestamp").alias("k"), F.input_file_name().alias("f"))
        .groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    )
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(path).count() == 20


def test_catalog_tables_and_views(spark, readings):
    catalog.create_tables(spark, "plant")
    catalog.create_tables(spark, "plant")
    table = spark.table("plant.sensor_readings")
    assert table.columns[-2:] == ["event_day", "sensor_type"]
    readings({}).withColumn("event_day", F.to_date("timestamp")).select(*table.columns).write.mode(
        "append"
    ).insertInto("plant.sensor_readings")
    catalog.create_tables(spark, "plant")
    assert spark.table("plant.sensor_readings").count() == 1
    from fieldpulse.operators.state import partial_states

    stored = spark.table("plant.sensor_readings")
    catalog.register_views(stored, partial_states(stored, 0), as_of="2024-01-02 00:00:00")
    assert spark.sql("SELECT readings FROM hourly_temperature").first()[0] == 1
    assert spark.sql("SELECT * FROM device_current").count() == 1
    assert spark.sql("SELECT * FROM anomalies").count() == 0
    spark.sql("DROP DATABASE plant CASCADE")


def test_written_results_live_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    kept = written(spark.range(3), "numbers")
    assert kept.count() == 3 and folder in kept.inputFiles()[0]
    clear_scratch(spark)
    assert not glob.glob(f"{folder}/fieldpulse/{spark.sparkContext.applicationId}")


def test_settled_partitions_are_read_without_a_merge(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for n, day in enumerate((1, 2, 2, 3)):
        tables.append_readings(
            readings({"timestamp": f"2024-01-0{day} 10:00:00", "value": float(n),
                      "ingest_time": f"2024-01-09 00:00:0{n}"}), path, n,
        )
    assert tables.settle_readings(spark, path, upto=1) == 1
    tables.settle_readings(spark, path, upto=3)
    assert _values(tables.read_readings(spark, path)) == [0.0, 2.0, 3.0]
    assert "Exchange" not in plan_of(tables.read_readings(spark, path))
    # Day 2 was touched again and moved to the second folder, day 1 was not.
    settled = sorted(f.split("settled/")[1] for f in glob.glob(f"{path}/settled/*/event_day=*"))
    assert settled == [
        "upto=1/event_day=2024-01-01", "upto=1/event_day=2024-01-02",
        "upto=3/event_day=2024-01-02", "upto=3/event_day=2024-01-03",
    ]
    tables.vacuum_readings(spark, path)
    assert len(glob.glob(f"{path}/settled/*/event_day=*/sensor_type=*")) == 3
    assert _values(tables.read_readings(spark, path)) == [0.0, 2.0, 3.0]

    tables.append_readings(
        readings({"timestamp": "2024-01-01 10:00:00", "value": 9.0, "ingest_time": "2024-01-10 00:00:00"}), path, 4
    )
    assert _values(tables.read_readings(spark, path)) == [2.0, 3.0, 9.0]
    untouched = tables.read_readings(spark, path, since="2024-01-02")
    assert _values(untouched) == [2.0, 3.0]
    assert tables.expire_readings(spark, path, datetime(2024, 2, 2, tzinfo=timezone.utc)) >= 2
    assert _values(tables.read_readings(spark, path)) == [3.0]
    assert tables.settle_readings(spark, path, upto=4) is None or _values(tables.read_readings(spark, path)) == [3.0]


def test_rejects_are_settled_and_expire(spark, readings, tmp_path):
    root = str(tmp_path)
    for n, day in enumerate((1, 8, 9)):
        refused = readings({"ingest_time": f"2024-01-0{day} 10:00:00"}).withColumns(
            {"payload": F.lit(f"p{n}"), "reject_reason": F.lit("malformed")}
        )
        tables.append_rejects(refused, f"{root}/rejects", n)
        tables.append_rejects(refused, f"{root}/refused_by_0", n)
    tables.maintain(spark, root, datetime(2024, 2, 5, tzinfo=timezone.utc))
    for name in ("rejects", "refused_by_0"):
        assert batches.settled_marks(spark, f"{root}/{name}") == [1]
        kept = tables.read_rejects(spark, f"{root}/{name}").collect()
        assert sorted(r.payload for r in kept) == ["p1", "p2"]


def test_views_show_rows_loaded_later(spark, readings):
    from fieldpulse.operators.state import partial_states

    catalog.create_tables(spark, "plant2")
    stored = spark.table("plant2.sensor_readings")
    catalog.register_views(stored, partial_states(stored, 0), as_of="2024-01-02 00:00:00")
    assert spark.sql("SELECT * FROM anomalies").count() == 0
    values = [{"value": 20.0 + i % 2, "timestamp": f"2024-01-01 10:00:{i:02d}"} for i in range(30)]
    rows = readings(*values, {"value": 90.0}).withColumn("event_day", F.to_date("timestamp"))
    rows.select(*stored.columns).write.mode("append").insertInto("plant2.sensor_readings")
    spark.catalog.refreshTable("plant2.sensor_readings")
    clear_scratch(spark)
    assert [r.value for r in spark.sql("SELECT value FROM anomalies").collect()] == [90.0]
    spark.sql("DROP DATABASE plant2 CASCADE")
