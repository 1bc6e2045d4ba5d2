"""One row per key: the latest version, or the first delivery in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldpulse.functions.instants import utc_second
from fieldpulse.schema import READING_KEY


def latest_version(
    readings: DataFrame,
    keys: list[str] = READING_KEY,
    version: list[str] = ("ingest_time",),
    whole_seconds: bool = False,
) -> DataFrame:
    """The row with the greatest ``version`` for each key.

    Rows of equal version are ordered by their remaining columns, so the answer
    does not depend on row order.  The choice is an aggregate: each task keeps
    one row per key before the shuffle, so copies of a key never meet in bulk.
    ``whole_seconds`` narrows ``timestamp`` first, as a store of seconds does.
    """
    if whole_seconds:
        readings = readings.withColumn("timestamp", utc_second(F.col("timestamp")))
    rest = [name for name in readings.columns if name not in [*keys, *version]]
    newest = F.max(F.struct(*version, *rest)).alias("_newest")
    return readings.groupBy(*keys).agg(newest).select(
        *[
            F.col(name) if name in keys else F.col(f"_newest.{name}").alias(name)
            for name in readings.columns
        ]
    )


def drop_redelivered(
    readings: DataFrame, delay: str = "2 minutes", keys: list[str] = READING_KEY
) -> DataFrame:
    """A stream with the first delivery of each key; state is kept for ``delay``."""
    return readings.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(keys)
