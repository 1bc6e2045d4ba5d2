"""Streams that keep tables: late corrections, anomalies, current state, reports."""

from __future__ import annotations

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import quality, windows
from fieldpulse.plans import reports as plans
from fieldpulse.sources import batches, tables
from fieldpulse.sources.topic import file_source
from fieldpulse.streaming import jobs, reports, sinks


@pytest.fixture
def feed(spark, tmp_path):
    """Writes message files, oldest first, and streams accepted readings one file per batch."""
    folder = tmp_path / "feed"
    folder.mkdir()
    count = iter(range(1000))

    class Feed:
        def add(self, *readings):
            n = next(count)
            lines = [json.dumps({
                "device_id": device, "location": "roof", "device_type": "weather", "sensor_type": "temperature",
                "value": float(value), "unit": "C", "quality": "good", "timestamp": f"2024-01-01T{at}+00:00",
            }) for device, at, value in readings]
            file = folder / f"{n:04d}.txt"
            file.write_text("\n".join(lines) + "\n")
            os.utime(file, (time.time() - 10_000 + n,) * 2)

        def clean(self):
            messages = file_source(str(folder), max_files_per_batch=1).stream(spark)
            return quality.accepted(quality.classify_messages(messages))

    return Feed()


def _failing_once(sink, at_batch):
    """A sink that fails after it has written one batch."""
    failed = []

    def write(rows, batch_id):
        sink.write(rows, batch_id)
        if batch_id == at_batch and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    return sinks.replace(sink, write=write)


def _run(start):
    """Start a query until it ends without failing."""
    for _ in range(3):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            continue
    raise AssertionError("the query never ended well")


# --- Late rows ----------------------------------------------------------------


def _late_feed(feed):
    feed.add(("d1", "10:00:00", 1), ("d1", "10:12:00", 2))
    feed.add(("d1", "10:04:00", 3), ("d1", "10:12:30", 4))
    feed.add(("d1", "10:04:30", 5), ("d2", "10:09:59", 6), ("d1", "10:10:00", 7), ("d1", "10:30:00", 8))
    feed.add(("d1", "10:01:00", 9), ("d1", "10:31:00", 10))


def _stats(spark, path):
    rows = tables.read_window_stats(spark, path).collect()
    return sorted(
        (str(r.window_start)[11:16], r.device_id, r.reading_count, r.avg_value, r.stddev_value) for r in rows
    )


CORRECTED = [
    ("10:00", "d1", 4, 4.5, 3.416), ("10:05", "d2", 1, 6.0, None), ("10:10", "d1", 3, 4.333, 2.517),
]


def test_late_rows_correct_their_windows_and_are_kept(spark, feed, tmp_path):
    _late_feed(feed)
    given = []
    strict = sinks.Sink("strict", lambda rows, n: given.extend(rows.collect()))
    jobs.start_window_stats(
        feed.clean(), [sinks.window_stats_sink(f"{tmp_path}/stats"), strict], f"{tmp_path}/ck", correct=True,
        late_sinks=[sinks.late_sink(f"{tmp_path}/late")],
    ).awaitTermination()
    assert _stats(spark, f"{tmp_path}/stats") == CORRECTED
    late = tables.read_late(spark, f"{tmp_path}/late").collect()
    assert sorted((r.device_id, r.value, str(r.watermark)[11:19]) for r in late) == [
        ("d1", 5.0, "10:10:00"), ("d1", 9.0, "10:10:30"), ("d2", 6.0, "10:10:00"),
    ]
    # A sink that cannot merge gets the windows as they were closed, and no partial rows.
    assert sorted((str(r.window_start)[11:16], r.reading_count) for r in given) == [("10:00", 2), ("10:10", 3)]
    for n in batches.fresh_batches(spark, f"{tmp_path}/stats"):
        tables.settle_window_stats(spark, f"{tmp_path}/stats", upto=n)
    assert _stats(spark, f"{tmp_path}/stats") == CORRECTED


def test_a_repeated_batch_corrects_once(spark, feed, tmp_path):
    _late_feed(feed)
    sink = _failing_once(sinks.window_stats_sink(f"{tmp_path}/stats"), 2)
    _run(lambda: jobs.start_window_stats(feed.clean(), [sink], f"{tmp_path}/ck", correct=True))
    assert _stats(spark, f"{tmp_path}/stats") == CORRECTED


def test_late_rows_and_redeliveries_exclude_each_other(feed, tmp_path):
    feed.add(("d1", "10:00:00", 1))
    with pytest.raises(ValueError, match="redeliveries"):
        jobs.start_window_stats(feed.clean(), [], f"{tmp_path}/ck", first_deliveries_only=True, correct=True)


# --- Anomalies ----------------------------------------------------------------


def test_anomalies_are_judged_by_the_batches_so_far(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOMENT_BATCHES", 1)
    steady = lambda hour: [("d1", f"{hour}:{m:02d}:00", 20 + m % 2) for m in range(20)]
    feed.add(*steady("10"), ("d1", "10:30:00", 60))
    feed.add(*steady("11"), ("d1", "11:30:00", 60), ("d2", "11:30:00", 99))
    feed.add(*[("d1", f"12:{m:02d}:00", 60) for m in range(30)])
    feed.add(*steady("13"), ("d1", "13:30:00", 110))
    sink = _failing_once(sinks.anomalies_sink(f"{tmp_path}/found"), 2)
    _run(lambda: jobs.start_anomalies(feed.clean(), f"{tmp_path}/moments", [sink], f"{tmp_path}/ck"))
    found = tables.read_anomalies(spark, f"{tmp_path}/found").collect()
    assert sorted(str(r.timestamp)[11:16] for r in found) == ["10:30", "11:30", "13:30"]
    assert batches.settled_marks(spark, f"{tmp_path}/moments")
    everything = tables.read_group_stats(spark, f"{tmp_path}/moments").orderBy("device_id").collect()
    rows = spark.read.schema("value STRING").text(str(tmp_path / "feed")).select(F.col("value"))
    plain = plans.device_sensor_stats(quality.accepted(quality.classify_messages(rows))).orderBy("device_id").collect()
    for got, expected in zip(everything, plain, strict=True):
        assert got.reading_count == expected.reading_count
        assert got.mean_val == pytest.approx(expected.mean_val)
        assert got.std_val == (None if expected.std_val is None else pytest.approx(expected.std_val))


def test_moments_of_one_row_keep_their_digits(spark):
    rows = spark.createDataFrame(
        [("a", "t", 3, 3, 0.1 + 0.2, 1e-17, 0.1, 0.2)], "device_id string, sensor_type string, reading_count long, "
        "value_count long, mean double, m2 double, min_value double, max_value double",
    )
    merged = windows.merge_moments(rows, ["device_id", "sensor_type"]).first()
    assert (merged.mean, merged.m2) == (0.1 + 0.2, 1e-17)


# --- Current state ------------------------------------------------------------


def test_current_state_follows_its_stream(spark, feed, tmp_path):
    start = lambda: jobs.start_current(
        feed.clean(), [_sink], f"{tmp_path}/ck", counted=False,
    )
    _sink = _failing_once(sinks.current_sink(f"{tmp_path}/current"), 1)
    feed.add(("d1", "10:00:00", 1), ("d2", "10:00:00", 2))
    feed.add(("d1", "10:05:00", 5))
    feed.add(("d1", "10:01:00", 9))
    _run(start)
    seen = lambda: sorted(
        (r.device_id, r.current_value, r.max_value, r.min_value, r.total_readings)
        for r in tables.read_current(spark, f"{tmp_path}/current").collect()
    )
    assert seen() == [("d1", 5.0, 9.0, 1.0, 3), ("d2", 2.0, 2.0, 2.0, 1)]
    # Only the groups a batch has changed are written.
    assert spark.read.parquet(f"{tmp_path}/current/fresh/batch_id=2").count() == 1
    tables.settle_current(spark, f"{tmp_path}/current")
    feed.add(("d2", "11:00:00", 7), ("d3", "11:00:00", 3))
    _run(start)
    assert seen() == [("d1", 5.0, 9.0, 1.0, 3), ("d2", 7.0, 7.0, 2.0, 2), ("d3", 3.0, 3.0, 3.0, 1)]
    beside = jobs.current_beside_state(spark, f"{tmp_path}/ck", f"{tmp_path}/current")
    assert [r.agrees for r in beside.collect()] == [True] * 3
    batches.storage.delete(spark, f"{tmp_path}/current/fresh/batch_id=3")
    lost = jobs.current_beside_state(spark, f"{tmp_path}/ck", f"{tmp_path}/current").filter("NOT agrees")
    assert sorted(r.device_id for r in lost.collect()) == ["d2", "d3"]


# --- Reports ------------------------------------------------------------------


def test_batches_are_reported_without_a_count(spark, feed, tmp_path, caplog):
    _late_feed(feed)
    listener = reports.BatchReports(spark, f"{tmp_path}/reports").attach()
    try:
        with caplog.at_level("INFO"):
            running = jobs.start_window_stats(
                feed.clean(), [sinks.window_stats_sink(f"{tmp_path}/stats")], f"{tmp_path}/ck", counted=False
            )
            running.awaitTermination()
        assert listener.wait_for(running)
    finally:
        listener.detach()
    assert "rows" not in caplog.text
    seen = lambda: [
        (r.batch_id, r.input_rows, str(r.watermark)[11:19], r.state_rows, r.name)
        for r in reports.read_reports(spark, f"{tmp_path}/reports").orderBy("batch_id").collect()
    ]
    expected = [
        (0, 2, "00:00:00", 2, "window_stats"), (1, 2, "10:10:00", 1, "window_stats"),
        (2, 4, "10:10:30", 2, "window_stats"), (3, 2, "10:28:00", 1, "window_stats"), (4, 0, "10:29:00", 1, "window_stats"),
    ]
    assert seen() == expected
    # Batch 0 closes nothing, so no folder is written for it.
    assert 0 not in batches.fresh_batches(spark, f"{tmp_path}/stats")
    kept = {f: open(f).read() for f in glob.glob(f"{tmp_path}/reports/reported/*.json")}
    assert reports.gather(spark, f"{tmp_path}/reports") == 5
    assert seen() == expected
    first = sorted(kept)[0]
    open(first, "w").write(kept[first])  # as after a run that died before it deleted it
    assert seen() == expected
    assert reports.gather(spark, f"{tmp_path}/reports") == 1
    assert seen() == expected
    assert reports.gather(spark, f"{tmp_path}/reports") == 0


def test_a_report_that_cannot_be_written_stops_nothing(spark, feed, tmp_path):
    feed.add(("d1", "10:00:00", 1))
    (tmp_path / "file").write_text("no folder")
    listener = reports.BatchReports(spark, f"{tmp_path}/file").attach()
    try:
        running = jobs.start_current(feed.clean(), [sinks.current_sink(f"{tmp_path}/current")], f"{tmp_path}/ck")
        running.awaitTermination()
        assert listener.wait_for(running)
    finally:
        listener.detach()
    assert tables.read_current(spark, f"{tmp_path}/current").count() == 1
    assert reports.read_reports(spark, f"{tmp_path}/none").count() == 0


def test_the_whole_job_with_everything_on(spark, feed, tmp_path, monkeypatch):
    from fieldpulse.streaming.app import Settings, start

    rows = [("d1", f"10:{m:02d}:00", 20 + m % 2) for m in range(30)] + [("d1", "10:31:00", 90)]
    feed.add(*rows)
    feed.add(("d1", "11:00:00", 20))
    feed.add(("d1", "11:10:00", 20))
    feed.add(("d1", "10:02:30", 20))
    messages = file_source(str(tmp_path / "feed"), max_files_per_batch=1)
    settings = Settings(
        messages, f"{tmp_path}/t", f"{tmp_path}/ck", None, None, correct_late_rows=True, judge_anomalies=True,
        alert_limits={"temperature": (10.0, 60.0)}, batch_reports=True,
    )
    running = start(spark, settings)
    assert len(running) == 4
    for query in running:
        query.awaitTermination()
    root = f"{tmp_path}/t"
    first = tables.read_window_stats(spark, f"{root}/window_stats").orderBy("window_start").first()
    assert first.reading_count == 6
    assert [r.value for r in tables.read_late(spark, f"{root}/late").collect()] == [20.0]
    assert [r.value for r in tables.read_anomalies(spark, f"{root}/anomalies").collect()] == [90.0]
    episode, = tables.read_episodes(spark, f"{root}/alerts").collect()
    assert (str(episode.raised_at)[11:16], str(episode.cleared_at)[11:16]) == ("10:31", "11:00")
    from datetime import datetime, timezone

    for _ in range(2):
        tables.maintain(spark, root, datetime(2024, 1, 5, tzinfo=timezone.utc))
        assert tables.read_window_stats(spark, f"{root}/window_stats").orderBy("window_start").first().reading_count == 6
        assert tables.read_readings(spark, f"{root}/readings").count() == 34
    env = {"TABLES_PATH": "t", "ALERT_LIMITS": '{"humidity": [1, 2]}', "CORRECT_LATE_ROWS": "true"}
    read = Settings.from_env(env)
    assert read.alert_limits == {"humidity": (1, 2)} and read.correct_late_rows and read.batch_reports
