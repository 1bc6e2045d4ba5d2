"""Settling by key filters: what is added, what is merged, what is read."""

from __future__ import annotations

import glob
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators import key_filter
from fieldpulse.sources import batches, tables


def _reading(readings, device, value, day=1, ingest=1):
    return readings({
        "device_id": device, "value": float(value), "timestamp": f"2024-01-{day:02d} 10:00:00",
        "ingest_time": f"2024-02-01 00:00:{ingest:02d}",
    })


def _stored(spark, path):
    return sorted((r.device_id, r.value, r.timestamp.day) for r in tables.read_readings(spark, path).collect())


def _spoil(files):
    """Make files unreadable; returns what puts them back."""
    kept = {}
    for file in files:
        check = f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc"
        kept |= {name: open(name, "rb").read() for name in (file, check) if os.path.exists(name)}
        for name in (file, check):
            if os.path.exists(name):
                os.remove(name)
        open(file, "wb").write(b"spoiled")

    def restore():
        for name, content in kept.items():
            open(name, "wb").write(content)

    return restore


def test_no_held_key_is_missed_and_few_others_are_met(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("k"), F.col("id")).alias("name"), (F.col("id") % 3).alias("part"),
        F.when(F.col("id") % 100 != 0, F.col("id")).alias("more"),
    )
    filters = key_filter.build(rows, ["part"], ["name", "more"])
    assert {f.name for f in filters.schema} == {"place", "blocks", "block", "bits"}
    assert filters.groupBy("place").count().count() == 3
    assert filters.selectExpr("max(length(bits))").first()[0] == key_filter.BLOCK_BITS // 8
    assert key_filter.maybe_held(rows, filters, ["part"], ["name", "more"]).count() == 20_000
    others = rows.withColumn("name", F.concat("name", F.lit("x")))
    assert key_filter.maybe_held(others, filters, ["part"], ["name", "more"]).count() < 200
    moved = rows.withColumn("part", F.lit(7))
    assert key_filter.maybe_held(moved, filters, ["part"], ["name", "more"]).count() == 0


def test_new_keys_are_added_without_reading_what_is_settled(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(_reading(readings, "d1", 1).unionByName(_reading(readings, "d9", 9, day=2)), path, 0)
    tables.settle_readings(spark, path, upto=0)
    tables.append_readings(_reading(readings, "d2", 2), path, 1)
    restore = _spoil(glob.glob(f"{path}/settled/upto=0/*/*/*.parquet"))
    assert tables.settle_readings(spark, path, upto=1) == 1
    restore()
    assert _stored(spark, path) == [("d1", 1.0, 1), ("d2", 2.0, 1), ("d9", 9.0, 2)]
    assert len(glob.glob(f"{path}/added/upto=1/*/*")) == 1
    assert glob.glob(f"{path}/settled/upto=1/*/*") == []


def test_a_replayed_key_is_merged_wherever_it_is_held(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for n, device in enumerate(("d1", "d2", "d3")):
        tables.append_readings(_reading(readings, device, n), path, n)
        tables.settle_readings(spark, path, upto=n)
    # d2 came in an added layer and comes again, newer; d3 comes again, older.
    again = _reading(readings, "d2", 22, ingest=9).unionByName(_reading(readings, "d3", 33, ingest=0))
    tables.append_readings(again.unionByName(_reading(readings, "d4", 4)), path, 3)
    expected = [("d1", 0.0, 1), ("d2", 22.0, 1), ("d3", 2.0, 1), ("d4", 4.0, 1)]
    assert _stored(spark, path) == expected
    tables.settle_readings(spark, path, upto=3)
    assert _stored(spark, path) == expected
    assert len(glob.glob(f"{path}/settled/upto=3/*/*")) == 1
    tables.vacuum_readings(spark, path)
    assert glob.glob(f"{path}/added/*/*/*") == []
    assert _stored(spark, path) == expected


def test_without_filters_the_keys_themselves_decide(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(_reading(readings, "d1", 1), path, 0)
    tables.settle_readings(spark, path, upto=0)
    batches.storage.delete(spark, f"{path}/filters")
    tables.append_readings(_reading(readings, "d1", 2, ingest=5).unionByName(_reading(readings, "d2", 3)), path, 1)
    tables.settle_readings(spark, path, upto=1)
    assert _stored(spark, path) == [("d1", 2.0, 1), ("d2", 3.0, 1)]
    batches.storage.delete(spark, f"{path}/filters")
    tables.append_readings(_reading(readings, "d5", 5), path, 2)
    tables.settle_readings(spark, path, upto=2)
    assert len(glob.glob(f"{path}/added/upto=2/*/*")) == 1
    assert _stored(spark, path) == [("d1", 2.0, 1), ("d2", 3.0, 1), ("d5", 5.0, 1)]


def test_what_a_dead_run_left_does_not_count(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.append_readings(_reading(readings, "d1", 1), path, 0)
    tables.settle_readings(spark, path, upto=0)
    tables.append_readings(_reading(readings, "d2", 2), path, 1)
    tables.settle_readings(spark, path, upto=1)
    os.remove(f"{path}/settled/upto=1/_SUCCESS")
    tables.append_readings(_reading(readings, "d1", 11, ingest=7), path, 1)
    assert _stored(spark, path) == [("d1", 11.0, 1)]
    tables.settle_readings(spark, path, upto=1)
    assert _stored(spark, path) == [("d1", 11.0, 1)]


@pytest.mark.parametrize("sensor_type", ["a/b c%", None, "temperature"])
def test_partition_names_that_are_escaped(spark, readings, tmp_path, sensor_type):
    path = str(tmp_path / "t")
    row = {"sensor_type": sensor_type, "timestamp": "2024-01-01 10:00:00"}
    tables.append_readings(readings({**row, "value": 1.0}), path, 0)
    tables.settle_readings(spark, path, upto=0)
    tables.append_readings(readings({**row, "value": 2.0, "ingest_time": "2024-02-01 00:00:00"}), path, 1)
    tables.settle_readings(spark, path, upto=1)
    assert [r.value for r in tables.read_readings(spark, path).collect()] == [2.0]


def test_folders_stay_bounded_over_many_settlings(spark, readings, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "LAYERS", 3)
    root = str(tmp_path)
    folders = []
    for n in range(14):
        refused = _reading(readings, f"d{n}", n).withColumns({"payload": F.lit("p"), "reject_reason": F.lit("r")})
        tables.append_rejects(refused, f"{root}/rejects", n)
        tables.append_readings(_reading(readings, f"d{n}", n), f"{root}/readings", n)
        tables.settle_rejects(spark, f"{root}/rejects", upto=n)
        tables.settle_readings(spark, f"{root}/readings", upto=n)
        batches.vacuum(spark, f"{root}/rejects", depth=1)
        tables.vacuum_readings(spark, f"{root}/readings")
        folders.append(sum(len(glob.glob(f"{root}/{t}/{k}/*")) for t in ("rejects", "readings") for k in (
            "fresh", "settled", "added", "filters")))
    assert max(folders[7:]) <= max(folders[:7]) <= 24
    assert tables.read_rejects(spark, f"{root}/rejects").count() == 14
    assert len(_stored(spark, f"{root}/readings")) == 14


def test_replaced_folders_stay_for_the_time_of_grace(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for n in range(2):
        tables.append_readings(_reading(readings, "d1", n, ingest=n + 1), path, n)
        tables.settle_readings(spark, path, upto=n)
    old_reader = tables.read_readings(spark, path)
    tables.vacuum_readings(spark, path, grace=timedelta(hours=1))
    assert len(glob.glob(f"{path}/fresh/*")) == 2
    assert len(glob.glob(f"{path}/settled/*/*/*")) == 2
    assert old_reader.count() == 1
    tables.vacuum_readings(spark, path)
    assert glob.glob(f"{path}/fresh/*") == []
    assert len(glob.glob(f"{path}/settled/*/*/*")) == 1


def test_days_expire_from_every_layer(spark, readings, tmp_path):
    from datetime import datetime, timezone

    path = str(tmp_path / "t")
    for n, day in enumerate((1, 1, 20)):
        tables.append_readings(_reading(readings, f"d{n}", n, day=day), path, n)
        tables.settle_readings(spark, path, upto=n)
    assert glob.glob(f"{path}/added/*/event_day=2024-01-01")
    tables.expire_readings(spark, path, datetime(2024, 2, 5, tzinfo=timezone.utc))
    assert _stored(spark, path) == [("d2", 2.0, 20)]


def _spy(monkeypatch, module, name):
    """Notes what a function of a module is called with."""
    calls, original = [], getattr(module, name)

    def noted(*args, **more):
        calls.append(args)
        return original(*args, **more)

    monkeypatch.setattr(module, name, noted)
    return calls


def _many(spark, readings, n, value, ingest):
    one = _reading(readings, "d", value, ingest=ingest)
    spread = spark.range(0, n, 1, 4).crossJoin(F.broadcast(one))
    return spread.withColumn("device_id", F.concat("device_id", "id")).drop("id")


def test_filters_set_the_bits_of_every_hash_from_one_row_a_key(spark):
    from conftest import plan_of

    rows = spark.range(5_000).select(F.concat(F.lit("k"), F.col("id")).alias("name"), (F.col("id") % 2).alias("part"))
    rows = rows.union(rows)
    built = key_filter.build(rows, ["part"], ["name"])
    sizes = built.select("place", "blocks").distinct()
    keyed = rows.withColumn("place", key_filter.place(["part"])).join(sizes, "place").select(
        "place", "blocks", F.expr("pmod(xxhash64('block', name), blocks)").alias("block"),
        F.expr("pmod(xxhash64('first', name), 32768)").alias("first"),
        F.expr("pmod(xxhash64('step', name), 32768)").alias("step"),
    )
    bits = keyed.select("place", "blocks", "block", F.explode(F.expr(
        "transform(sequence(0, 7), n -> pmod(first + n * step, 32768))"
    )).alias("bit"))
    expected = bits.groupBy("place", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    taken = lambda df: sorted((r.place, r.blocks, r.block, bytes(r.bits)) for r in df.collect())
    assert taken(built.select("place", "blocks", "block", "bits")) == taken(expected)
    assert len(taken(expected)) > 2
    # No row is multiplied below the bitmaps.
    plan = plan_of(built).split("== Physical Plan ==")[1]
    assert plan.index("Generate") < plan.index("bitmap_construct_agg")


def test_a_replay_is_known_by_a_share_of_its_keys(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_readings(_many(spark, readings, 6400, 1, ingest=1), path, 0)
    tables.settle_readings(spark, path, upto=0)
    looked_up = _spy(monkeypatch, batches, "written")
    tables.append_readings(_many(spark, readings, 6400, 2, ingest=2), path, 1)
    tables.settle_readings(spark, path, upto=1)
    assert 0 < sum(rows.count() for rows, _ in looked_up) < 640
    stored = tables.read_readings(spark, path)
    assert (stored.count(), stored.select("value").distinct().collect()) == (6400, [(2.0,)])


@pytest.mark.parametrize("held", range(0, 200, 40))
def test_one_held_key_among_many_new_ones_is_found(spark, readings, tmp_path, held):
    path = str(tmp_path / "t")
    tables.append_readings(_reading(readings, f"d{held}", 1, ingest=1), path, 0)
    tables.settle_readings(spark, path, upto=0)
    tables.append_readings(_many(spark, readings, 200, 2, ingest=2), path, 1)
    tables.settle_readings(spark, path, upto=1)
    stored = tables.read_readings(spark, path)
    assert (stored.count(), stored.select("value").distinct().collect()) == (200, [(2.0,)])


def test_new_rows_are_merged_among_themselves_and_written_once(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_readings(_reading(readings, "d1", 1), path, 0)
    tables.settle_readings(spark, path, upto=0)
    tables.append_readings(_reading(readings, "d2", 2), path, 1)
    tables.append_readings(_reading(readings, "d2", 3, ingest=5), path, 2)
    targets = _spy(monkeypatch, batches, "_write")
    tables.settle_readings(spark, path, upto=2)
    assert [args[1].removeprefix(path) for args in targets] == ["/added/upto=2", "/settled/upto=2"]
    assert _stored(spark, path) == [("d1", 1.0, 1), ("d2", 3.0, 1)]


@pytest.mark.parametrize("usual", [None, "32m"])
def test_a_big_fresh_batch_is_written_by_several_tasks(spark, readings, tmp_path, monkeypatch, usual):
    monkeypatch.setattr(batches, "FRESH_BYTES", 4096)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if usual:
        spark.conf.set(setting, usual)
    try:
        tables.append_readings(_many(spark, readings, 20_000, 1, ingest=1), str(tmp_path), 0)
        assert len(glob.glob(f"{tmp_path}/fresh/batch_id=0/*/*/*.parquet")) > 1
        assert spark.conf.get(setting, None) == usual
    finally:
        spark.conf.unset(setting)
    assert tables.read_readings(spark, str(tmp_path)).count() == 20_000
