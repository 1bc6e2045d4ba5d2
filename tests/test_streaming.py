from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import quality, windows
from fieldpulse.operators.latest import drop_redelivered
from fieldpulse.schema import WINDOW_STATS_COLUMNS
from fieldpulse.sources import tables
from fieldpulse.sources.topic import file_source
from fieldpulse.streaming import jobs, sinks
from fieldpulse.streaming.app import Settings, start


def _text(time, device="d1", value=20.0, **more):
    return json.dumps({
        "device_id": device, "location": "roof", "device_type": "weather",
        "sensor_type": "temperature", "value": value, "unit": "C", "quality": "good",
        "timestamp": time and f"2024-01-01T{time}+00:00", **more,
    })


@pytest.fixture
def feed(tmp_path):
    """Writes message files, oldest first, and streams them one file per batch."""
    folder = tmp_path / "feed"
    folder.mkdir()
    count = iter(range(1000))

    class Feed:
        path = str(folder)

        def add(self, *lines):
            n = next(count)
            file = folder / f"{n:04d}.txt"
            file.write_text("\n".join(lines) + "\n")
            stamp = time.time() - 10_000 + n
            os.utime(file, (stamp, stamp))

        def stream(self, spark):
            return file_source(self.path, max_files_per_batch=1).stream(spark)

    return Feed()


def _clean(spark, feed):
    return quality.accepted(quality.classify_messages(feed.stream(spark)))


def _run_stats(spark, feed, base, **options):
    query = jobs.start_window_stats(
        _clean(spark, feed), [sinks.window_stats_sink(f"{base}/stats")], f"{base}/ck", **options
    )
    query.awaitTermination()
    rows = tables.read_window_stats(spark, f"{base}/stats").collect()
    return query, sorted((str(r.window_start)[11:16], r.reading_count) for r in rows)


def test_late_rows_and_open_windows(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), _text("10:12:00"))
    feed.add(_text("10:04:00"), _text("10:12:30"))
    feed.add(_text("10:04:30"), _text("10:09:59"), _text("10:10:00"), _text("10:30:00"))
    query, got = _run_stats(spark, feed, tmp_path)
    assert got == [("10:00", 2), ("10:10", 3)]
    dropped = sum(
        s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators
    )
    assert 1 <= dropped <= 2


def test_statistics_stream_equals_batch_for_closed_windows(spark, feed, tmp_path):
    lines = [
        _text(f"10:{m:02d}:{s:02d}", device=f"d{m % 3}", value=float((m * s) % 17))
        for m in range(30) for s in range(0, 60, 20)
    ]
    for n in range(0, len(lines), 30):
        feed.add(*lines[n:n + 30], _text(None))
    _run_stats(spark, feed, tmp_path)
    streamed = tables.read_window_stats(spark, f"{tmp_path}/stats").select(*WINDOW_STATS_COLUMNS)
    batch = quality.accepted(quality.classify_messages(file_source(feed.path).batch(spark)))
    newest = F.lit(batch.agg(F.max("timestamp")).first()[0])
    expected = windows.closed_windows(windows.window_stats(batch), newest)
    assert expected.count() > 0
    assert sorted(map(str, streamed.collect())) == sorted(map(str, expected.collect()))


def test_stored_window_statistics_roll_up(spark, feed, tmp_path):
    feed.add(*[_text(f"10:{m:02d}:00", value=float(m)) for m in range(60)])
    feed.add(_text("12:00:00"))
    feed.add(_text("12:00:01"))
    _run_stats(spark, feed, tmp_path)
    stored = tables.read_window_stats(spark, f"{tmp_path}/stats")
    (row,) = windows.present_moments(windows.rollup_windows(stored, "1 hour")).collect()
    assert (row.reading_count, row.avg_value, row.stddev_value) == (60, 29.5, 17.464)


def test_redelivery_is_counted_once_when_asked(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), _text("10:01:00"))
    feed.add(_text("10:01:00"), _text("10:01:30"))
    feed.add(_text("10:30:00"))
    feed.add(_text("10:30:01"))
    assert _run_stats(spark, feed, tmp_path / "all")[1] == [("10:00", 4)]
    once = _run_stats(spark, feed, tmp_path / "once", first_deliveries_only=True)[1]
    assert once == [("10:00", 3)]


def test_dedupe_operator_keeps_the_first(spark, feed, tmp_path):
    feed.add(_text("10:00:00", value=1.0))
    feed.add(_text("10:00:00", value=2.0), _text("10:00:01", value=3.0))
    seen = []
    jobs.start_batches(
        drop_redelivered(_clean(spark, feed)),
        lambda batch, n: seen.extend(r.value for r in batch.collect()), "dedupe",
        f"{tmp_path}/ck",
    ).awaitTermination()
    assert sorted(seen) == [1.0, 3.0]


def test_future_clock_guard(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), json.dumps({**json.loads(_text("10:00:00")),
                                            "timestamp": "2199-01-01T00:00:00Z"}))
    classified = quality.classify_messages(feed.stream(spark), clock_allowance="1 hour")
    seen = []
    jobs.start_batches(
        classified, lambda b, n: seen.extend(r.reject_reason for r in b.collect()), "guard",
        f"{tmp_path}/ck",
    ).awaitTermination()
    assert sorted(map(str, seen)) == ["None", "future_clock"]


def _start_readings(spark, feed, base, extra=()):
    return jobs.start_readings(
        feed.stream(spark),
        [sinks.readings_sink(f"{base}/readings"), sinks.states_sink(f"{base}/states"), *extra],
        f"{base}/ck",
        reject_sinks=[sinks.rejects_sink(f"{base}/rejects")],
    )


def _contents(spark, base):
    current = tables.read_device_current(spark, f"{base}/states").collect()
    return (
        sorted(r.value for r in tables.read_readings(spark, f"{base}/readings").collect()),
        sum(r.total_readings for r in current),
        sorted(r.reject_reason for r in tables.read_rejects(spark, f"{base}/rejects").collect()),
    )


def test_routes_restart_and_late_readings(spark, feed, tmp_path):
    feed.add(_text("10:00:00", value=1.0), "junk", _text("10:00:01", value=999.0))
    _start_readings(spark, feed, tmp_path).awaitTermination()
    feed.add(_text("12:00:00", value=2.0))
    feed.add(_text("09:00:00", value=3.0), _text("09:00:01", quality="bad"))
    _start_readings(spark, feed, tmp_path).awaitTermination()
    _start_readings(spark, feed, tmp_path).awaitTermination()
    assert _contents(spark, tmp_path) == (
        [1.0, 2.0, 3.0], 3, ["bad_quality", "malformed", "out_of_range"],
    )


def test_a_failed_batch_is_repeated_without_doubling(spark, feed, tmp_path):
    feed.add(_text("10:00:00", value=1.0))
    feed.add(_text("10:00:01", value=2.0), "junk")
    broken = [True]

    def fail_once(rows, batch_id):
        if batch_id == 1 and broken.pop() if broken else False:
            raise RuntimeError("database down")
        rows.write.format("noop").mode("overwrite").save()

    flaky = sinks.Sink("flaky", fail_once)
    with pytest.raises(Exception, match="database down"):
        _start_readings(spark, feed, tmp_path, [flaky]).awaitTermination()
    assert sorted(os.listdir(f"{tmp_path}/readings/fresh")) == ["batch_id=0", "batch_id=1"]
    _start_readings(spark, feed, tmp_path, [flaky]).awaitTermination()
    assert _contents(spark, tmp_path) == ([1.0, 2.0], 2, ["malformed"])


def test_empty_batches_write_nothing(spark, feed, tmp_path):
    feed.add("")
    calls = []
    empty = quality.accepted(quality.classify_messages(feed.stream(spark)))
    jobs.start_batches(empty, lambda b, n: calls.append(n), "empty", f"{tmp_path}/ck").awaitTermination()
    assert calls == []


def test_batches_of_only_good_or_only_bad_messages(spark, feed, tmp_path, caplog):
    feed.add(_text("10:00:00", value=1.0))
    feed.add("junk", "more junk")
    with caplog.at_level("INFO", logger="fieldpulse.streaming.jobs"):
        _start_readings(spark, feed, tmp_path).awaitTermination()
    assert _contents(spark, tmp_path) == ([1.0], 1, ["malformed", "malformed"])
    assert os.listdir(f"{tmp_path}/readings/fresh") == ["batch_id=0"]
    assert os.listdir(f"{tmp_path}/rejects/fresh") == ["batch_id=1"]
    assert "readings, batch 0: 1 rows" in caplog.messages
    assert "readings, batch 1: 2 rows" in caplog.messages


@pytest.mark.parametrize("line, expected", [(_text("10:00:00"), [20.0]), ("junk", [])])
def test_a_single_sink_without_persisting(spark, feed, tmp_path, line, expected):
    feed.add(line)
    jobs.start_readings(
        feed.stream(spark), [sinks.readings_sink(f"{tmp_path}/t")], f"{tmp_path}/ck"
    ).awaitTermination()
    assert [r.value for r in tables.read_readings(spark, f"{tmp_path}/t").collect()] == expected


def test_republish_stream(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), "junk")
    messages = feed.stream(spark).withColumn("topic", F.lit("sensors/temperature/d1"))
    out = []
    collect = sinks.Sink("out", lambda rows, n: out.extend(rows.collect()))
    jobs.start_republish(messages, [collect], f"{tmp_path}/ck").awaitTermination()
    assert [r.key for r in out] == ["sensors/temperature/d1"]
    assert json.loads(out[0].value)["mqtt_topic"] == "sensors/temperature/d1"
    out.clear()
    jobs.start_republish(
        messages, [collect], f"{tmp_path}/ck2", topics="other/#"
    ).awaitTermination()
    assert out == []


def test_missing_format_fails_before_the_stream_starts(spark, feed, tmp_path):
    missing = sinks.topic_sink("kafka", "localhost:9092", "out")
    with pytest.raises(ValueError, match="class path"):
        _start_readings(spark, feed, tmp_path, [missing])
    assert not os.path.exists(f"{tmp_path}/ck")


def test_whole_job_and_supervision(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), "junk")
    feed.add(_text("10:20:00"))
    settings = Settings(
        file_source(feed.path), f"{tmp_path}/tables", f"{tmp_path}/ck",
        readings_every=None, stats_every=None,
    )
    spark.streams.resetTerminated()
    queries = start(spark, settings)
    for query in queries:
        query.awaitTermination()
    assert _contents(spark, tmp_path / "tables") == ([20.0, 20.0], 2, ["malformed"])
    assert tables.read_window_stats(spark, f"{tmp_path}/tables/window_stats").count() == 1


def test_strict_sinks_get_conforming_rows_only(spark, feed, tmp_path):
    feed.add(_text("10:00:00", value=1.0), _text(None, value=2.0), _text("10:00:01", device=None))
    taken = []
    strict = sinks.Sink("strict", lambda rows, n: taken.extend(rows.collect()))
    settings = Settings(
        file_source(feed.path), f"{tmp_path}/tables", f"{tmp_path}/ck",
        readings_every=None, stats_every=None, extra_reading_sinks=[strict],
    )
    for query in start(spark, settings):
        query.awaitTermination()
    assert [r.value for r in taken] == [1.0]
    refused = tables.read_rejects(spark, f"{tmp_path}/tables/refused_by_0").collect()
    assert sorted(r.reject_reason for r in refused) == ["device_id:null", "timestamp:null"]
    assert _contents(spark, tmp_path / "tables") == ([1.0, 2.0, 20.0], 3, [])


def test_supervision_stops_the_sibling_and_raises(spark, feed, tmp_path):
    feed.add(_text("10:00:00"))
    spark.streams.resetTerminated()

    def fail(batch, n):
        raise RuntimeError("broken")

    healthy = jobs.start_batches(
        _clean(spark, feed), lambda b, n: None, "healthy", f"{tmp_path}/a", every="1 second"
    )
    failing = jobs.start_batches(_clean(spark, feed), fail, "failing", f"{tmp_path}/b", every="1 second")
    with pytest.raises(Exception, match="broken"):
        jobs.supervise(spark, [healthy, failing])
    assert not healthy.isActive
    spark.streams.resetTerminated()


def test_another_stream_or_a_reset_checkpoint_is_refused(spark, feed, tmp_path):
    from fieldpulse.sources import batches

    def run(checkpoint):
        jobs.start_readings(
            feed.stream(spark), [sinks.readings_sink(f"{tmp_path}/t")], f"{tmp_path}/{checkpoint}"
        ).awaitTermination()

    def stored():
        return sorted(r.value for r in tables.read_readings(spark, f"{tmp_path}/t").collect())

    for n in range(5):
        feed.add(_text(f"10:00:0{n}", value=float(n)))
    run("ck1")
    with pytest.raises(Exception, match="another stream"):
        run("ck2")
    assert stored() == [0.0, 1.0, 2.0, 3.0, 4.0]
    feed.add(_text("10:00:05", value=5.0))
    run("ck1")
    assert stored() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert batches.take_over(spark, f"{tmp_path}/t") == 6
    feed.add(_text("10:00:06", value=6.0))
    run("ck3")
    assert stored() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert batches.fresh_batches(spark, f"{tmp_path}/t") == list(range(13))
    feed.add(_text("10:00:07", value=7.0))
    with pytest.raises(Exception, match="another stream"):
        run("ck1")
    run("ck3")
    assert stored()[-1] == 7.0 and len(stored()) == 8


def test_stateful_batches_leave_few_files(spark, feed, tmp_path):
    import glob

    feed.add(*[_text(f"10:{m:02d}:00", device=f"d{d}", value=float(m)) for m in range(60) for d in range(20)])
    feed.add(_text("12:00:00"))
    feed.add(_text("12:00:01"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        _run_stats(spark, feed, tmp_path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    folders = glob.glob(f"{tmp_path}/stats/fresh/batch_id=*/event_day=*")
    assert folders and all(len(glob.glob(f"{f}/part-*")) == 1 for f in folders)


def test_a_big_stateful_batch_is_split(spark, readings, tmp_path, monkeypatch):
    import glob

    from fieldpulse.sources import batches

    monkeypatch.setattr(batches, "FILE_ROWS", 100)
    rows = readings(*[{"device_id": f"d{i}"} for i in range(450)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.append_readings(rows, f"{tmp_path}/t", 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = glob.glob(f"{tmp_path}/t/fresh/batch_id=0/event_day=*/sensor_type=*/part-*")
    assert 2 <= len(files) <= 5
    assert tables.read_readings(spark, f"{tmp_path}/t").count() == 450


def test_statistics_sinks_get_the_declared_columns(spark, feed, tmp_path):
    from fieldpulse.plans.catalog import TABLES

    feed.add(_text("10:00:00"))
    feed.add(_text("10:20:00"))
    got = []
    external = sinks.Sink("external", lambda rows, n: got.append(rows.columns))
    settings = Settings(
        file_source(feed.path), f"{tmp_path}/tables", f"{tmp_path}/ck",
        readings_every=None, stats_every=None, extra_stats_sinks=[external],
    )
    for query in start(spark, settings):
        query.awaitTermination()
    assert got and all(columns == WINDOW_STATS_COLUMNS for columns in got)
    stored = tables.read_window_stats(spark, f"{tmp_path}/tables/window_stats")
    declared = [c.split()[0] for c in TABLES["sensor_aggregations"][0].split(", ")]
    assert stored.columns == declared and len(WINDOW_STATS_COLUMNS) == 10


def test_refused_rows_keep_their_payload_and_leave_no_empty_folders(spark, feed, tmp_path):
    feed.add(_text("10:00:00", value=1.0))
    feed.add(_text(None, value=2.0), _text("10:00:01", value=3.0))
    strict = sinks.checked_sink(sinks.Sink("s", lambda rows, n: None), sinks.rejects_sink(f"{tmp_path}/refused"))
    _start_readings(spark, feed, tmp_path, [strict]).awaitTermination()
    (refused,) = tables.read_rejects(spark, f"{tmp_path}/refused").collect()
    assert json.loads(refused.payload)["value"] == 2.0
    assert os.listdir(f"{tmp_path}/refused/fresh") == ["batch_id=1"]
    assert "payload" not in tables.batches.read_batches(
        spark, f"{tmp_path}/readings", tables.READINGS_TABLE_DDL
    ).columns


def test_republish_keeps_what_it_cannot_forward(spark, feed, tmp_path):
    feed.add(_text("10:00:00"), "junk", "[1]")
    messages = feed.stream(spark).withColumn("topic", F.lit("sensors/temperature/d1"))
    out = []
    jobs.start_republish(
        messages, [sinks.Sink("out", lambda rows, n: out.extend(rows.collect()))], f"{tmp_path}/ck",
        reject_sinks=[sinks.rejects_sink(f"{tmp_path}/rejects")],
    ).awaitTermination()
    refused = tables.read_rejects(spark, f"{tmp_path}/rejects").collect()
    assert len(out) == 1
    assert sorted((r.payload, r.reject_reason) for r in refused) == [("[1]", "malformed"), ("junk", "malformed")]
    assert {r.mqtt_topic for r in refused} == {"sensors/temperature/d1"}


def test_one_sink_is_counted_like_many(spark, feed, tmp_path, caplog):
    feed.add(_text("10:00:00"), "junk")
    with caplog.at_level("INFO", logger="fieldpulse.streaming.jobs"):
        jobs.start_readings(
            feed.stream(spark), [sinks.readings_sink(f"{tmp_path}/t")], f"{tmp_path}/ck"
        ).awaitTermination()
    assert "readings, batch 0: 2 rows" in caplog.messages


def test_streams_need_a_named_folder_for_checkpoints(spark, feed, tmp_path, monkeypatch):
    from fieldpulse.streaming import app

    def unset(_):
        raise ValueError("set spark.checkpoint.dir")

    monkeypatch.setattr(app, "configured_folder", unset)
    with pytest.raises(ValueError, match="checkpoint.dir"):
        start(spark, Settings(file_source(feed.path), f"{tmp_path}/tables"))


@pytest.mark.parametrize("wanted", [False, True])
def test_messages_are_kept_with_the_batch_only_where_a_sink_wants_them(spark, feed, tmp_path, monkeypatch, wanted):
    feed.add(_text("10:00:00"), "junk")
    kept, original = [], jobs.start_batches
    monkeypatch.setattr(jobs, "start_batches", lambda rows, *a, **k: kept.append(rows.columns) or original(rows, *a, **k))
    rejects = [sinks.rejects_sink(f"{tmp_path}/r")] if wanted else []
    jobs.start_readings(
        feed.stream(spark), [sinks.readings_sink(f"{tmp_path}/t")], f"{tmp_path}/ck", reject_sinks=rejects,
    ).awaitTermination()
    assert ("payload" in kept[0]) == wanted
    assert [r.value for r in tables.read_readings(spark, f"{tmp_path}/t").collect()] == [20.0]
