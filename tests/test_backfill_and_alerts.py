"""History in steps of time; alert episodes in one go and over batches."""

from __future__ import annotations

import glob
import os
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fieldpulse.operators import episodes, windows
from fieldpulse.sources import tables
from fieldpulse.streaming import backfill, jobs, sinks

LIMITS = {"temperature": (10.0, 60.0)}


def _stats_start(base):
    return lambda stream: jobs.start_window_stats(
        stream, [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint"
    )


def _minutes(readings, count=60, seed=1):
    rng = random.Random(seed)
    rows = [{"timestamp": f"2024-01-01 {10 + n // 60}:{n % 60:02d}:00", "value": float(n % 7)} for n in range(count)]
    rng.shuffle(rows)
    return readings(*rows)


# --- Backfill -----------------------------------------------------------------


def test_steps_are_ranges_of_time_of_like_size(spark, readings, tmp_path):
    rows = _minutes(readings).unionByName(readings({"timestamp": None}))
    assert backfill.stage_by_time(rows, str(tmp_path), 4) == 4
    staged = spark.read.parquet(f"{tmp_path}/staged")
    found = staged.groupBy("step").agg(F.count("*"), F.min("timestamp"), F.max("timestamp")).orderBy("step").collect()
    assert all(13 <= r[1] <= 18 for r in found)
    assert all(a[3] < b[2] for a, b in zip(found, found[1:]))
    assert staged.count() == 61
    same = readings(*[{"timestamp": "2024-01-01 10:00:00"}] * 9)
    assert backfill.stage_by_time(same, f"{tmp_path}/same", 4) <= 2
    assert spark.read.parquet(f"{tmp_path}/same/staged").select("step").distinct().count() == 1
    assert backfill.stage_by_time(rows.limit(0), f"{tmp_path}/none", 3) == 1


def test_several_batches_close_the_same_windows(spark, readings, tmp_path):
    rows = _minutes(readings, 120)
    backfill.stage_by_time(rows, str(tmp_path), 5)
    assert backfill.run_steps(spark, str(tmp_path), rows.schema, _stats_start(str(tmp_path))) == 5
    got = tables.read_window_stats(spark, f"{tmp_path}/table").drop("event_day")
    newest = F.lit("2024-01-01 11:59:00").cast("timestamp")
    expected = windows.closed_windows(windows.window_stats(rows), newest)
    assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert len(glob.glob(f"{tmp_path}/checkpoint/commits/[0-9]*")) >= 5


def test_a_backfill_goes_on_after_a_failure(spark, readings, tmp_path):
    rows = _minutes(readings, 60)
    base = str(tmp_path)
    backfill.stage_by_time(rows, base, 3)
    lost = []

    def start(stream):
        if len(glob.glob(f"{base}/entered/*")) == 2 and not lost:
            lost.append(True)
            raise RuntimeError("lost")
        return _stats_start(base)(stream)

    with pytest.raises(RuntimeError):
        backfill.run_steps(spark, base, rows.schema, start)
    assert backfill.waiting_steps(spark, base) == [2]
    assert backfill.run_steps(spark, base, rows.schema, start) == 1
    assert tables.read_window_stats(spark, f"{base}/table").agg(F.sum("reading_count")).first()[0] == 55
    assert os.listdir(f"{base}/staged") == ["_SUCCESS"] or backfill.waiting_steps(spark, base) == []


# --- Episodes -----------------------------------------------------------------


def _plain(rows, margin=0.1):
    """Episodes by a state machine over each group's readings in order."""
    out = []
    for key in sorted({(r["device_id"], r["sensor_type"]) for r in rows}):
        low, high = LIMITS.get(key[1], (None, None))
        if low is None:
            continue
        raised = None
        mine = sorted(
            (r for r in rows if (r["device_id"], r["sensor_type"]) == key),
            key=lambda r: (r["timestamp"], r["ingest_time"], r["value"]),
        )
        for r in mine:
            v, inner = r["value"], (high - low) * margin
            said = "below" if v < low else "above" if v > high else "clear" if low + inner <= v <= high - inner else None
            if said is None:
                continue
            if raised and raised["alert"] != said:
                out.append((*key, raised["alert"], raised["at"], r["timestamp"], raised["peak"], raised["n"]))
                raised = None
            if said != "clear":
                if not raised:
                    raised = {"alert": said, "at": r["timestamp"], "peak": v, "n": 0}
                raised["peak"] = max(raised["peak"], v) if said == "above" else min(raised["peak"], v)
                raised["n"] += 1
        if raised:
            out.append((*key, raised["alert"], raised["at"], None, raised["peak"], raised["n"]))
    return sorted(map(str, out))


def _random_rows(seed, count=300):
    rng = random.Random(seed)
    return [{
        "device_id": rng.choice(["d1", "d2"]), "sensor_type": rng.choice(["temperature", "temperature", "humidity"]),
        "timestamp": f"2024-01-01 {rng.randint(10, 13)}:{rng.randint(0, 59):02d}:00",
        "ingest_time": f"2024-01-02 00:00:{rng.randint(0, 59):02d}",
        "value": float(rng.choice([5, 9, 12, 16, 30, 54, 57, 61, 70])),
    } for _ in range(count)]


def _shown(df):
    return sorted(str((
        r.device_id, r.sensor_type, r.alert, str(r.raised_at), r.cleared_at and str(r.cleared_at), r.peak, r.readings,
    )) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_episodes_equal_a_state_machine(readings, seed):
    rows = _random_rows(seed)
    got = _shown(episodes.alert_episodes(readings(*rows), LIMITS))
    assert got == _plain(rows) and len(got) > 20


def test_odd_readings_raise_nothing(readings):
    rows = readings(
        {"value": None}, {"timestamp": None, "value": 99.0}, {"device_id": None, "value": 99.0},
        {"sensor_type": "co2", "value": 9999.0}, {"value": float("nan"), "device_id": "n"},
    )
    found = episodes.alert_episodes(rows, LIMITS).collect()
    assert [r.device_id for r in found] in ([], ["n"])  # NaN counts as above every limit
    assert episodes.alert_episodes(rows.limit(0), LIMITS).count() == 0


def test_a_busy_sensor_is_ordered_by_the_hour_first(readings):
    plan = plan_of(episodes.signal_runs(readings({}), LIMITS))
    assert "hour" in plan.split("Window", 1)[1]


def test_a_stream_raises_once_and_clears_once(spark, readings, tmp_path):
    rows = _random_rows(3)
    base = str(tmp_path)
    lost = []

    def start(stream):
        return jobs.start_alerts(
            stream, f"{base}/alerts", LIMITS, f"{base}/checkpoint", late_sinks=[late], counted=False
        )

    def keep_late(batch, batch_id):
        if batch_id == 2 and not lost:
            lost.append(True)
            raise RuntimeError("lost after the write")
        tables.append_late(batch.withColumn("watermark", F.lit(None).cast("timestamp")), f"{base}/late", batch_id)

    late = sinks.Sink("late", keep_late)
    df = readings(*rows)
    backfill.stage_by_time(df, base, 5)
    backfill.run_steps(spark, base, df.schema, start)
    assert _shown(tables.read_episodes(spark, f"{base}/alerts")) == _plain(rows)
    # An older reading changes nothing and is kept aside; a batch that fails after its write is repeated.
    older = readings({"timestamp": "2024-01-01 09:00:00", "value": 99.0}, {"timestamp": "2024-01-01 20:00:00", "value": 30.0})
    backfill.stage_by_time(older, f"{base}/more", 1)
    os.makedirs(f"{base}/entered", exist_ok=True)
    os.rename(f"{base}/more/staged/step=0", f"{base}/entered/000009")
    for _ in range(2):
        try:
            backfill.run_steps(spark, base, df.schema, start)
        except Exception:
            continue
    ended = rows + [{**rows[0], "device_id": "d1", "sensor_type": "temperature", "timestamp": "2024-01-01 20:00:00",
                     "value": 30.0}]
    assert _shown(tables.read_episodes(spark, f"{base}/alerts")) == _plain(ended)
    assert [r.value for r in tables.read_late(spark, f"{base}/late").collect()] == [99.0]
    tables.settle_episodes(spark, f"{base}/alerts")
    assert _shown(tables.read_episodes(spark, f"{base}/alerts")) == _plain(ended)
