"""Replaying refused messages after a rule has changed.

A run takes every message that is still refused and classifies it anew: those the stream
refused since the run before, up to a batch that the run writes down first, and those the
run before refused again. What passes now goes to a reading table of the replays; what does
not is kept with its ``attempt``, the number of runs that have refused it after the stream.

A run that dies is repeated under its number: it has written down what it takes, so it
takes the same and replaces what it wrote. Readings keep the ingest time of their message:
one that the device delivers again later is newer and wins, as in the stream's own table.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpulse import storage
from fieldpulse.operators import quality
from fieldpulse.operators.latest import latest_version
from fieldpulse.schema import PLAUSIBLE_RANGES, REJECT_DDL
from fieldpulse.sources import batches, tables

REFUSED_DDL = REJECT_DDL + ", attempt INT"


def _run(spark: SparkSession, path: str, number: int) -> dict | None:
    """What run ``number`` wrote down before it began."""
    file = f"{path}/runs/{number}.json"
    return json.loads(storage.read_text(spark, file)) if storage.exists(spark, file) else None


def _last_run(spark: SparkSession, path: str) -> int:
    """The last run that came to its end, -1 if there was none."""
    return max(batches.fresh_batches(spark, f"{path}/refused"), default=-1)


def _refused(spark: SparkSession, path: str, number: int) -> DataFrame:
    """What a run refused again."""
    if number < 0:
        return spark.createDataFrame([], REFUSED_DDL)
    return spark.read.schema(REFUSED_DDL).parquet(f"{path}/refused/fresh/batch_id={number}")


def _to_replay(spark: SparkSession, rejects: str, path: str, last: int, upto: int | None) -> DataFrame:
    """Messages refused after run ``last`` took its own, up to a batch, and those it refused."""
    seen = _run(spark, path, last)["upto"] if last >= 0 else -1
    arrived = tables.read_arrived(spark, rejects).filter(F.col("arrived") > seen)
    if upto is not None:
        arrived = arrived.filter(F.col("arrived") <= upto)
    new = arrived.drop("arrived").withColumn("attempt", F.lit(0))
    return new.unionByName(_refused(spark, path, last))


def pending(spark: SparkSession, rejects: str, path: str) -> DataFrame:
    """Every message that is refused up to now, with its number of attempts."""
    return _to_replay(spark, rejects, path, _last_run(spark, path), None)


def replay_rejects(
    spark: SparkSession,
    rejects: str,
    path: str,
    ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES,
    clock_allowance: str | None = None,
) -> int | None:
    """Classify what is pending by new rules; returns the run's number, None if nothing had come.

    ``rejects`` is the stream's table of refused messages, ``path`` the replays' folder.
    """
    last = _last_run(spark, path)
    number = last + 1
    plan = _run(spark, path, number)
    if plan is None:
        newest = tables.read_arrived(spark, rejects).agg(F.max("arrived")).first()[0]
        if newest is None:
            return None
        plan = {"upto": newest}
        storage.write_text(spark, f"{path}/runs/{number}.json", json.dumps(plan))
    taken = _to_replay(spark, rejects, path, last, plan["upto"])
    messages = taken.select("payload", "ingest_time", "attempt")
    classified = quality.classify_messages(
        messages, payload="payload", keep=["ingest_time", "attempt"], ranges=ranges, clock_allowance=clock_allowance,
    ).persist()
    try:
        tables.append_readings(quality.accepted(classified).drop("attempt"), f"{path}/readings", number)
        again = quality.rejected(classified).withColumn("attempt", F.col("attempt") + 1)
        columns = [column.split()[0] for column in REFUSED_DDL.split(", ")]
        batches.append_batch(again.select(*columns), f"{path}/refused", number, sort_by=["reject_reason"])
    finally:
        classified.unpersist()
    return number


def read_with_replays(spark: SparkSession, readings: str, path: str) -> DataFrame:
    """The latest version of every reading, the stream's and the replayed ones together."""
    rows = reduce(DataFrame.unionByName, [
        tables.read_readings(spark, folder) for folder in (readings, f"{path}/readings")
    ])
    return latest_version(rows, tables.VERSION_KEY)


def forget(spark: SparkSession, path: str) -> None:
    """Settle the replayed readings and delete what earlier runs refused, which later ones have taken."""
    last = _last_run(spark, path)
    if last >= 0:
        tables.settle_readings(spark, f"{path}/readings", upto=last)
    for number in batches.fresh_batches(spark, f"{path}/refused")[:-1]:
        storage.delete(spark, f"{path}/refused/fresh/batch_id={number}")
