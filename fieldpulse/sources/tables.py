"""The stored tables: readings, window statistics, device states."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpulse import storage
from fieldpulse.functions.instants import utc_date
from fieldpulse.operators.episodes import EPISODE_DDL, RUN_DDL, episodes
from fieldpulse.operators.latest import latest_version
from fieldpulse.operators.state import device_current, merge_states, partial_states, present_states
from fieldpulse.operators.windows import MEASURES, group_moments, merge_moments, present_moments
from fieldpulse.plans.reports import retained
from fieldpulse.schema import (
    ANOMALY_DDL,
    GROUP_KEY,
    MERGEABLE_STATS_DDL,
    MOMENTS_DDL,
    READING_KEY,
    REJECT_DDL,
    STATE_DDL,
    STATE_KEY,
    STORED_READING_DDL,
    WINDOW_KEY,
)
from fieldpulse.sources import batches

READINGS_LAYOUT = {
    "partition_by": ["event_day", "sensor_type"],
    "sort_by": ["device_id", "timestamp"],
}
STATS_LAYOUT = {
    "partition_by": ["event_day"],
    "sort_by": ["device_id", "sensor_type", "window_start"],
}
REJECTS_LAYOUT = {"partition_by": ["event_day"], "sort_by": ["reject_reason"]}
READINGS_TABLE_DDL = STORED_READING_DDL + ", event_day DATE"
#: ``arrived`` is the number of the batch that refused a message.
REJECTS_TABLE_DDL = REJECT_DDL + ", arrived BIGINT, event_day DATE"
STATS_TABLE_DDL = MERGEABLE_STATS_DDL + ", event_day DATE"
VERSION_KEY = [*READING_KEY, "event_day"]
PARTIAL_DDL = STATE_DDL.removesuffix(", batch_id BIGINT")
#: How long :func:`maintain` leaves replaced folders to readers that listed them.
GRACE = timedelta(days=1)


# --- Readings ---------------------------------------------------------------


def append_readings(readings: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch, partitioned by UTC day and sensor type.

    Readings without ``ingest_time`` get the current time.
    """
    if "ingest_time" not in readings.columns:
        readings = readings.withColumn("ingest_time", F.lit(None).cast("timestamp"))
    filled = readings.withColumn(
        "ingest_time", F.coalesce("ingest_time", F.current_timestamp())
    )
    stored = filled.withColumn("event_day", utc_date(F.col("timestamp")))
    batches.append_batch(stored, path, batch_id, **READINGS_LAYOUT)


def read_readings(
    spark: SparkSession,
    path: str,
    since: date | str | None = None,
    until: date | str | None = None,
    whole_seconds: bool = False,
) -> DataFrame:
    """The latest version of every stored reading.

    Settled partitions are merged already and are only scanned; the merge runs
    over partitions with fresh rows.  The day and the sensor type are functions of
    the key, so filters on ``event_day`` and ``sensor_type`` reach the partitions.
    ``whole_seconds`` narrows the key and merges everything again.
    """
    merged, loose = batches.read_merged(
        spark, path, READINGS_TABLE_DDL, len(READINGS_LAYOUT["partition_by"])
    )
    parts = []
    if merged is not None:
        merged = batches.day_filter(merged, since, until)
        parts.append(latest_version(merged, VERSION_KEY, whole_seconds=True) if whole_seconds else merged)
    if loose is not None:
        loose = batches.day_filter(loose, since, until)
        parts.append(latest_version(loose, VERSION_KEY, whole_seconds=whole_seconds))
    if not parts:
        return spark.createDataFrame([], READINGS_TABLE_DDL)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def settle_readings(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Bring fresh batches into the partitions they touch; the others are not read.

    New readings are added to a partition; one that came before is merged into it.
    """
    return batches.settle_partitions(
        spark, path, READINGS_TABLE_DDL, lambda rows: latest_version(rows, VERSION_KEY),
        upto=upto, key=["device_id", "timestamp"], **READINGS_LAYOUT,
    )


def vacuum_readings(spark: SparkSession, path: str, grace: timedelta = timedelta(0)) -> None:
    """Free the space of what was settled, once no reader uses it any more."""
    batches.vacuum(
        spark, path, depth=len(READINGS_LAYOUT["partition_by"]), grace_seconds=grace.total_seconds()
    )


def expire_readings(spark: SparkSession, path: str, as_of: datetime, days: int = 30) -> int:
    """Delete the day partitions that lie wholly beyond the retention time, of rejects as well."""
    boundary = as_of.astimezone(timezone.utc) - timedelta(days=days)
    return batches.drop_days_before(spark, path, boundary.date())


def read_retained(spark: SparkSession, path: str, as_of: datetime, days: int = 30) -> DataFrame:
    """Stored readings within the retention time; the boundary day is filtered by row."""
    boundary = as_of.astimezone(timezone.utc) - timedelta(days=days)
    live = read_readings(spark, path, since=boundary.date())
    return retained(live, F.lit(as_of), days)


def write_clustered(
    df: DataFrame, path: str, time: str = "timestamp", files: int | None = None
) -> None:
    """Write ordered by sensor type and UTC day, so that readers can skip files.

    Device, time and a row number continue the range key: a day of one type that
    is too big for one file is cut instead of filling a single task.
    """
    key = [F.col("sensor_type"), utc_date(F.col(time)), F.col("device_id"), F.col(time)]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    cut = [*([files] if files else []), *key, F.col("_row")]
    ranged = numbered.repartitionByRange(*cut).sortWithinPartitions(*key).drop("_row")
    ranged.write.mode("overwrite").parquet(path)


# --- Rejects ----------------------------------------------------------------


def append_rejects(rejects: DataFrame, path: str, batch_id: int) -> None:
    """Store refused messages by the UTC day they came in; the payload is kept as it came, for replay."""
    number = batches.batch_number(rejects.sparkSession, path, batch_id)
    stored = rejects.withColumns({
        "arrived": F.lit(number).cast("bigint"), "event_day": utc_date(F.col("ingest_time")),
    })
    batches.append_batch(stored, path, batch_id, **REJECTS_LAYOUT)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return read_arrived(spark, path).drop("arrived")


def read_arrived(spark: SparkSession, path: str) -> DataFrame:
    """The refused messages with the number of the batch each ``arrived`` in."""
    settled, loose = batches.read_merged(spark, path, REJECTS_TABLE_DDL, len(REJECTS_LAYOUT["partition_by"]))
    parts = [part for part in (settled, loose) if part is not None]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], REJECTS_TABLE_DDL)
    return rows.drop("event_day")


def settle_rejects(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Gather the batches' folders; no row is merged with another."""
    return batches.settle_partitions(spark, path, REJECTS_TABLE_DDL, None, upto=upto, **REJECTS_LAYOUT)


# --- Window statistics ------------------------------------------------------


def append_window_stats(stats: DataFrame, path: str, batch_id: int) -> None:
    """Store closed windows, or late moments of them, partitioned by the UTC day of their start."""
    stored = stats.withColumn("event_day", utc_date(F.col("window_start")))
    batches.append_batch(stored, path, batch_id, **STATS_LAYOUT)


def merge_window_stats(rows: DataFrame) -> DataFrame:
    """Stored statistics with one row per window and group; late moments correct the closed row."""
    moments = rows.select(*WINDOW_KEY, *MEASURES)
    merged = present_moments(merge_moments(moments, WINDOW_KEY), keep_moments=True)
    columns = [column.split()[0] for column in MERGEABLE_STATS_DDL.split(", ")]
    return merged.select(*columns, utc_date(F.col("window_start")).alias("event_day"))


def read_window_stats(
    spark: SparkSession, path: str, since: date | str | None = None, until: date | str | None = None
) -> DataFrame:
    """Every window's statistics, late corrections included.

    Settled days are merged already and are only scanned; days with fresh rows are merged.
    """
    merged, loose = batches.read_merged(spark, path, STATS_TABLE_DDL, len(STATS_LAYOUT["partition_by"]))
    parts = []
    if merged is not None:
        parts.append(batches.day_filter(merged, since, until))
    if loose is not None:
        parts.append(merge_window_stats(batches.day_filter(loose, since, until)))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], STATS_TABLE_DDL)


def settle_window_stats(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Add fresh windows to their days; a day that gets late moments of a window it has is merged."""
    return batches.settle_partitions(
        spark, path, STATS_TABLE_DDL, merge_window_stats, upto=upto, key=WINDOW_KEY, **STATS_LAYOUT
    )


LATE_TABLE_DDL = STORED_READING_DDL + ", watermark TIMESTAMP, event_day DATE"


def append_late(readings: DataFrame, path: str, batch_id: int) -> None:
    """Store readings that missed their window, by their UTC day."""
    columns = [column.split()[0] for column in LATE_TABLE_DDL.split(", ")]
    for name in {"ingest_time", "watermark"} - set(readings.columns):
        readings = readings.withColumn(name, F.lit(None).cast("timestamp"))
    stored = readings.withColumn("event_day", utc_date(F.col("timestamp"))).select(*columns)
    batches.append_batch(stored, path, batch_id, **READINGS_LAYOUT)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """All late readings; no row is merged with another."""
    settled, loose = batches.read_merged(spark, path, LATE_TABLE_DDL, len(READINGS_LAYOUT["partition_by"]))
    parts = [part for part in (settled, loose) if part is not None]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], LATE_TABLE_DDL)


def settle_late(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    return batches.settle_partitions(spark, path, LATE_TABLE_DDL, None, upto=upto, **READINGS_LAYOUT)


# --- Device states ----------------------------------------------------------


def append_states(readings: DataFrame, path: str, batch_id: int) -> None:
    """Store the partial states of one micro-batch of accepted readings."""
    batches.append_batch(partial_states(readings, batch_id).drop("batch_id"), path, batch_id)


def read_device_current(spark: SparkSession, path: str) -> DataFrame:
    """Current state per device, sensor and location from all stored partials."""
    return device_current(batches.read_batches(spark, path, PARTIAL_DDL, cumulative=True))


def settle_states(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Merge fresh partials and the previous result into one row per group.

    States outlive the readings they came from: retention does not touch them.
    """
    return batches.settle(
        spark, path, PARTIAL_DDL, merge_states, cumulative=True, upto=upto,
        sort_by=["device_id", "sensor_type"],
    )


# --- Current states by update ------------------------------------------------------

CURRENT_DDL = PARTIAL_DDL + ", as_of BIGINT"


def append_current(states: DataFrame, path: str, batch_id: int) -> None:
    """Store the states a batch has changed; each replaces what the table has of its group."""
    number = batches.batch_number(states.sparkSession, path, batch_id)
    batches.append_batch(states.withColumn("as_of", F.lit(number).cast("bigint")), path, batch_id)


def newest_states(rows: DataFrame) -> DataFrame:
    """Of each group the state of the last batch that changed it."""
    rest = ["latest", "max_value", "min_value", "total_readings"]
    newest = rows.groupBy(*STATE_KEY).agg(F.max(F.struct("as_of", *rest)).alias("newest"))
    return newest.select(*STATE_KEY, *[f"newest.{name}" for name in [*rest, "as_of"]])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Current state per device, sensor and location, from the states as they were last updated."""
    rows = batches.read_batches(spark, path, CURRENT_DDL, cumulative=True)
    return present_states(newest_states(rows))


def settle_current(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    return batches.settle(
        spark, path, CURRENT_DDL, newest_states, cumulative=True, upto=upto, sort_by=["device_id", "sensor_type"],
    )


# --- Statistics per group and anomalies ---------------------------------------------

#: Batches of moments that may gather before the stream itself settles them.
MOMENT_BATCHES = 64
_ANOMALIES_TABLE_DDL = ANOMALY_DDL + ", event_day DATE"


def append_group_moments(readings: DataFrame, path: str, batch_id: int) -> None:
    """Store the moments a batch adds to each group; a batch that is repeated replaces its own."""
    batches.append_batch(group_moments(readings.dropna(subset=GROUP_KEY)), path, batch_id)


def read_group_stats(spark: SparkSession, path: str) -> DataFrame:
    """Mean and sample standard deviation per group over all stored batches."""
    rows = batches.read_batches(spark, path, MOMENTS_DDL, cumulative=True)
    merged = merge_moments(rows, GROUP_KEY)
    spread = F.when(F.col("value_count") > 1, F.sqrt(F.col("m2") / (F.col("value_count") - 1)))
    return merged.select(*GROUP_KEY, F.col("mean").alias("mean_val"), spread.alias("std_val"), "reading_count")


def settle_group_moments(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Merge the batches' moments and the previous result into one row per group."""
    return batches.settle(
        spark, path, MOMENTS_DDL, lambda rows: merge_moments(rows, GROUP_KEY), cumulative=True, upto=upto,
        sort_by=GROUP_KEY,
    )


def append_anomalies(found: DataFrame, path: str, batch_id: int) -> None:
    columns = [column.split()[0] for column in _ANOMALIES_TABLE_DDL.split(", ")]
    stored = found.withColumn("event_day", utc_date(F.col("timestamp"))).select(*columns)
    batches.append_batch(stored, path, batch_id, ["event_day"], GROUP_KEY)


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    settled, loose = batches.read_merged(spark, path, _ANOMALIES_TABLE_DDL, 1)
    parts = [part for part in (settled, loose) if part is not None]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _ANOMALIES_TABLE_DDL)
    return rows.drop("event_day")


def settle_anomalies(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    return batches.settle_partitions(
        spark, path, _ANOMALIES_TABLE_DDL, None, ["event_day"], GROUP_KEY, upto=upto
    )


# --- Alert episodes --------------------------------------------------------------

_EPISODES_TABLE_DDL = EPISODE_DDL + ", event_day DATE"


def append_episodes(ended: DataFrame, path: str, batch_id: int) -> None:
    """Store episodes that have ended, by the UTC day they were raised."""
    stored = ended.withColumn("event_day", utc_date(F.col("raised_at")))
    batches.append_batch(stored, f"{path}/ended", batch_id, ["event_day"], GROUP_KEY)


def append_alert_runs(runs: DataFrame, path: str, batch_id: int) -> None:
    """Store the run every group is in after a batch, in place of all before."""
    batches.append_batch(runs, f"{path}/runs", batch_id)


def read_alert_runs(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The run every group was in before batch ``before`` of the stream, or is in now."""
    folder = f"{path}/runs"
    stored = batches.fresh_batches(spark, folder)
    if before is not None:
        number = batches.batch_number(spark, folder, before)
        stored = [n for n in stored if n < number]
    if not stored:
        return spark.createDataFrame([], RUN_DDL)
    return spark.read.schema(RUN_DDL).parquet(f"{folder}/fresh/batch_id={stored[-1]}")


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """All episodes, those that have ended and those that go on."""
    settled, loose = batches.read_merged(spark, f"{path}/ended", _EPISODES_TABLE_DDL, 1)
    parts = [part.drop("event_day") for part in (settled, loose) if part is not None]
    return reduce(DataFrame.unionByName, [*parts, episodes(read_alert_runs(spark, path))])


def settle_episodes(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Gather the ended episodes; runs of batches before the last two are of no use any more."""
    for n in batches.fresh_batches(spark, f"{path}/runs")[:-2]:
        storage.delete(spark, f"{path}/runs/fresh/batch_id={n}")
    return batches.settle_partitions(
        spark, f"{path}/ended", _EPISODES_TABLE_DDL, None, ["event_day"], GROUP_KEY, upto=upto
    )


# --- Upkeep -----------------------------------------------------------------


def maintain(
    spark: SparkSession, root: str, as_of: datetime, days: int = 30, grace: timedelta = GRACE,
    publish: Callable[[], object] | None = None,
) -> None:
    """Settle the tables of a streaming job, rejects included, drop expired days, free space.

    To be run beside the stream now and then.  What was replaced less than ``grace``
    ago stays for readers that listed it; so folders do not gather.  ``publish`` is
    called when all is settled and nothing freed yet, to show it in a catalog.
    """
    settle_readings(spark, f"{root}/readings")
    settle_window_stats(spark, f"{root}/window_stats")
    settle_states(spark, f"{root}/states")
    for name in ("late", "late_for_alerts"):
        settle_late(spark, f"{root}/{name}")
    settle_current(spark, f"{root}/current")
    settle_group_moments(spark, f"{root}/group_moments")
    settle_anomalies(spark, f"{root}/anomalies")
    settle_episodes(spark, f"{root}/alerts")
    for name in ("readings", "late", "late_for_alerts"):
        expire_readings(spark, f"{root}/{name}", as_of, days)
    refused = [name for name in storage.child_folders(spark, root) if name.startswith("refused_by_")]
    for name in ("rejects", *refused):
        settle_rejects(spark, f"{root}/{name}")
        expire_readings(spark, f"{root}/{name}", as_of, days)
    if publish:
        publish()
    for name, depth in (("readings", 2), ("late", 2), ("late_for_alerts", 2), ("window_stats", 1), ("anomalies", 1), ("alerts/ended", 1), *((name, 1) for name in ("rejects", *refused))):
        batches.vacuum(spark, f"{root}/{name}", depth=depth, grace_seconds=grace.total_seconds())
    for name in ("states", "current", "group_moments"):
        batches.vacuum(spark, f"{root}/{name}", cumulative=True, grace_seconds=grace.total_seconds())

