"""Replays of refused messages; tables whose files cover narrow ranges."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import quality
from fieldpulse.schema import PLAUSIBLE_RANGES
from fieldpulse.sources import batches, clustered, replay, tables

WIDER = {**PLAUSIBLE_RANGES, "temperature": (-40.0, 300.0)}
WIDEST = {**PLAUSIBLE_RANGES, "temperature": (-40.0, 1000.0)}


@pytest.fixture
def refused(spark, tmp_path):
    """Adds messages to a table of rejects, as a stream with the plausible ranges would."""

    def add(batch, *values, at="2024-01-02 00:00:00"):
        texts = [(json.dumps({
            "device_id": f"d{v}", "location": "roof", "device_type": "weather", "sensor_type": "temperature",
            "value": float(v), "unit": "C", "quality": "good", "timestamp": "2024-01-01T10:00:00+00:00",
        }) if isinstance(v, int) else v, at) for v in values]
        messages = spark.createDataFrame(texts, "value string, ingest_time string").withColumn(
            "ingest_time", F.col("ingest_time").cast("timestamp")
        )
        classified = quality.classify_messages(messages, keep=["ingest_time"])
        tables.append_rejects(quality.rejected(classified), f"{tmp_path}/rejects", batch)

    return add


def _state(spark, tmp_path):
    root = str(tmp_path)
    read = replay.read_with_replays(spark, f"{root}/readings", f"{root}/replays")
    pending = replay.pending(spark, f"{root}/rejects", f"{root}/replays")
    return (
        sorted(r.value for r in read.collect()),
        sorted((r.reject_reason, r.attempt) for r in pending.collect()),
    )


def test_replays_take_each_message_once_and_count_attempts(spark, refused, tmp_path):
    rejects, path = f"{tmp_path}/rejects", f"{tmp_path}/replays"
    assert replay.replay_rejects(spark, rejects, path) is None
    refused(0, 200, 500, 2000, "no json")
    refused(1, 250)
    assert _state(spark, tmp_path) == ([], [("malformed", 0)] + [("out_of_range", 0)] * 4)
    assert replay.replay_rejects(spark, rejects, path, WIDER) == 0
    assert _state(spark, tmp_path) == ([200.0, 250.0], [("malformed", 1), ("out_of_range", 1), ("out_of_range", 1)])
    tables.settle_rejects(spark, rejects, upto=1)
    refused(2, 600)
    assert replay.replay_rejects(spark, rejects, path, WIDEST) == 1
    expected = ([200.0, 250.0, 500.0, 600.0], [("malformed", 2), ("out_of_range", 2)])
    assert _state(spark, tmp_path) == expected
    replay.forget(spark, path)
    assert _state(spark, tmp_path) == expected
    refused(3, 700)
    assert _state(spark, tmp_path)[1] == [("malformed", 2), ("out_of_range", 0), ("out_of_range", 2)]


def test_a_replay_that_dies_is_repeated_with_the_same_messages(spark, refused, tmp_path, monkeypatch):
    rejects, path = f"{tmp_path}/rejects", f"{tmp_path}/replays"
    refused(0, 200, 500)
    write = batches.append_batch

    def die(df, target, *args, **options):
        if target.endswith("/refused"):
            raise RuntimeError("lost")
        write(df, target, *args, **options)

    with monkeypatch.context() as patched:
        patched.setattr(batches, "append_batch", die)
        with pytest.raises(RuntimeError):
            replay.replay_rejects(spark, rejects, path, WIDER)
    refused(1, 210)  # comes after the run has written down what it takes
    assert replay.replay_rejects(spark, rejects, path, WIDER) == 0
    assert _state(spark, tmp_path) == ([200.0], [("out_of_range", 0), ("out_of_range", 1)])
    assert replay.replay_rejects(spark, rejects, path, WIDER) == 1
    assert _state(spark, tmp_path) == ([200.0, 210.0], [("out_of_range", 2)])


def test_a_message_delivered_again_wins_over_its_replay(spark, refused, readings, tmp_path):
    refused(0, 200, at="2024-01-02 00:00:00")
    replay.replay_rejects(spark, f"{tmp_path}/rejects", f"{tmp_path}/replays", WIDER)
    again = {"device_id": "d200", "value": 201.0, "ingest_time": "2024-01-05 00:00:00"}
    tables.append_readings(readings(again), f"{tmp_path}/readings", 0)
    assert _state(spark, tmp_path)[0] == [201.0]


# --- Clusters -----------------------------------------------------------------


def _files(spark, path):
    return sorted(r["file"] for r in clustered.files(spark, path).collect())


def _rows(readings, day, devices, **more):
    return readings(*[
        {"device_id": f"d{n:03d}", "timestamp": f"2024-01-{day:02d} 10:00:00", "value": float(n), **more} for n in devices
    ])


@pytest.fixture
def ranged(spark):
    """Few rows in several files each, as many rows would be."""
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)


def test_only_files_that_overlap_are_written_anew(spark, readings, tmp_path, ranged):
    path = str(tmp_path / "c")
    clustered.append_clustered(_rows(readings, 1, range(100)), path)
    apart = _files(spark, path)
    for _ in range(3):
        clustered.append_clustered(_rows(readings, 5, range(100)), path)
    schema = _rows(readings, 1, [1]).schema
    judged = clustered.overlaps(clustered.files(spark, path))
    assert judged.agg(F.max("depth")).first()[0] >= 3
    assert judged.filter("depth = 1").count() == len(apart) > 1
    taken = clustered.recluster(spark, path, schema, depth=1)
    assert taken == judged.count() - len(apart)
    assert set(apart) <= set(_files(spark, path))
    assert clustered.overlaps(clustered.files(spark, path)).agg(F.max("depth")).first()[0] == 1
    assert clustered.recluster(spark, path, schema, depth=1) == 0
    stored = clustered.read_clustered(spark, path, schema)
    assert stored.count() == 400
    assert stored.groupBy("device_id").count().filter("count <> 4").count() == 0
    clustered.vacuum_clustered(spark, path)
    assert clustered.read_clustered(spark, path, schema).count() == 400
    assert len(clustered.versions(spark, path)) == 1


def test_shallow_chains_stay_and_a_dead_run_changes_nothing(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    schema = _rows(readings, 1, [1]).schema
    assert clustered.recluster(spark, path, schema) == 0
    assert clustered.read_clustered(spark, path, schema).count() == 0
    for _ in range(2):
        clustered.append_clustered(_rows(readings, 1, range(10)), path)
    assert clustered.recluster(spark, path, schema, depth=2) == 0

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(clustered, "_commit", die)
        with pytest.raises(RuntimeError):
            clustered.recluster(spark, path, schema, depth=1)
    assert clustered.read_clustered(spark, path, schema).count() == 20
    assert clustered.recluster(spark, path, schema, depth=1) == 2
    assert clustered.read_clustered(spark, path, schema).count() == 20


def test_the_sweep_finds_chains_and_depths(spark):
    ranges = {"a": (0, 10), "b": (5, 8), "c": (6, 20), "d": (20, 30), "e": (31, 31), "f": (31, 31), "g": (31, 40), "h": (50, 60)}
    listed = spark.createDataFrame([(f, (low,), (high,), 1) for f, (low, high) in ranges.items()],
                                   "file string, low struct<at: int>, high struct<at: int>, rows long")
    found = {r.file: (r.chain, r.depth) for r in clustered.overlaps(listed).collect()}
    assert found["a"] == found["b"] == found["c"] and found["a"][1] == 3
    assert len({found[f][0] for f in "adegh"}) >= 4
    assert found["d"][1] == found["h"][1] == 1


def test_copies_of_one_instant_and_missing_values(spark, readings, tmp_path, ranged):
    path = str(tmp_path / "c")
    rows = readings(*[{"device_id": None}] * 3, *[{"timestamp": None}] * 2, *[{}] * 50)
    for _ in range(2):
        clustered.append_clustered(rows, path)
    clustered.recluster(spark, path, rows.schema, depth=1)
    assert clustered.read_clustered(spark, path, rows.schema).count() == 110
