"""Alert episodes: raised once by a breach, cleared only well within the limits.

A reading beyond a limit of its sensor type signals ``below`` or ``above``; one inside the
limits by a margin signals ``clear``; what lies between changes nothing. An episode runs
from a breach to the first clear reading or breach of the other side. Readings are put in
order by time, then ingest time, then value, so copies and ties have one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpulse.functions.instants import utc_hour
from fieldpulse.schema import GROUP_KEY

RUN_DDL = (
    "device_id STRING, sensor_type STRING, signal STRING, "
    "first STRUCT<timestamp: TIMESTAMP, ingest_time: TIMESTAMP, value: DOUBLE>, "
    "last STRUCT<timestamp: TIMESTAMP, ingest_time: TIMESTAMP, value: DOUBLE>, "
    "highest DOUBLE, lowest DOUBLE, readings BIGINT"
)
EPISODE_DDL = (
    "device_id STRING, sensor_type STRING, alert STRING, raised_at TIMESTAMP, cleared_at TIMESTAMP, "
    "peak DOUBLE, readings BIGINT"
)
_MEASURES = ["signal", "first", "last", "highest", "lowest", "readings"]


def signal(limits: dict[str, tuple[float, float]], margin: float) -> Column:
    """What a reading says of its sensor; ``margin`` is a share of the range between the limits."""
    low = high = inner = F.lit(None).cast("double")
    for kind, (lowest, highest) in limits.items():
        of_kind = F.col("sensor_type") == kind
        low = F.when(of_kind, F.lit(float(lowest))).otherwise(low)
        high = F.when(of_kind, F.lit(float(highest))).otherwise(high)
        inner = F.when(of_kind, F.lit((highest - lowest) * margin)).otherwise(inner)
    value = F.col("value")
    return (
        F.when(value < low, "below").when(value > high, "above")
        .when(value.between(low + inner, high - inner), "clear")
    )


def signal_runs(readings: DataFrame, limits: dict[str, tuple[float, float]], margin: float = 0.1) -> DataFrame:
    """Runs of equal signals per device, sensor and hour.

    The hour cuts a busy sensor's readings into many sequences, each put in order by a task
    of its own; what is left of them is a row per change and hour.
    """
    place = F.struct("timestamp", "ingest_time", "value")
    said = readings.dropna(subset=[*GROUP_KEY, "timestamp"]).select(
        *GROUP_KEY, utc_hour(F.col("timestamp")).alias("hour"), signal(limits, margin).alias("signal"),
        place.alias("first"), place.alias("last"), F.col("value").alias("highest"), F.col("value").alias("lowest"),
        F.lit(1).cast("bigint").alias("readings"),
    ).filter(F.col("signal").isNotNull())
    return merge_runs(said, [*GROUP_KEY, "hour"]).drop("hour")


def merge_runs(runs: DataFrame, keys: list[str] = GROUP_KEY) -> DataFrame:
    """Runs that follow each other with the same signal made one."""
    in_order = Window.partitionBy(*keys).orderBy("first", "last")
    begins = F.coalesce(F.lag("signal").over(in_order) != F.col("signal"), F.lit(True))
    numbered = runs.withColumn("begins", begins.cast("int"))
    numbered = numbered.withColumn("run", F.sum("begins").over(in_order))
    return numbered.groupBy(*keys, "run").agg(
        F.first("signal").alias("signal"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("highest").alias("highest"), F.min("lowest").alias("lowest"), F.sum("readings").alias("readings"),
    ).select(*keys, *_MEASURES)


def episodes(runs: DataFrame, open_too: bool = True) -> DataFrame:
    """The episodes among merged runs; ``cleared_at`` is NULL for one that goes on."""
    in_order = Window.partitionBy(*GROUP_KEY).orderBy("first")
    ended = runs.withColumn("cleared_at", F.lead("first").over(in_order).getField("timestamp"))
    found = ended.filter(F.col("signal") != "clear").select(
        *GROUP_KEY, F.col("signal").alias("alert"), F.col("first.timestamp").alias("raised_at"), "cleared_at",
        F.when(F.col("signal") == "above", F.col("highest")).otherwise(F.col("lowest")).alias("peak"), "readings",
    )
    return found if open_too else found.filter(F.col("cleared_at").isNotNull())


def last_runs(runs: DataFrame) -> DataFrame:
    """The run each group is in: what the next readings continue or end."""
    newest = runs.groupBy(*GROUP_KEY).agg(F.max(F.struct("last", *[m for m in _MEASURES if m != "last"])).alias("run"))
    return newest.select(*GROUP_KEY, *[F.col(f"run.{name}").alias(name) for name in _MEASURES])


def alert_episodes(
    readings: DataFrame, limits: dict[str, tuple[float, float]], margin: float = 0.1
) -> DataFrame:
    """All episodes among stored readings."""
    return episodes(merge_runs(signal_runs(readings, limits, margin)))
