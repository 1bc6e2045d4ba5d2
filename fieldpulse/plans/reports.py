"""The analytical queries over stored readings, statistics and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpulse.functions.checks import z_score
from fieldpulse.functions.instants import as_instant, day_number, utc_date, utc_hour
from fieldpulse.operators.groups import (
    BROADCAST_BYTES,
    HOT_ROWS,
    SHARES,
    attach_group_rows,
    split_hot_groups,
    table_bytes,
)
from fieldpulse.operators.ordering import newest_first, top_newest
from fieldpulse.schema import GROUP_KEY
from fieldpulse.session import written

ANOMALY_COLUMNS = [
    "device_id", "sensor_type", "location", "value", "mean_val", "std_val", "z_score", "timestamp",
]


def recent(readings: DataFrame, days: int, as_of: Column | str | None = None) -> DataFrame:
    """Readings of the last ``days`` days up to any time, the boundary included.

    On a table partitioned by ``event_day`` only the days concerned are read.
    """
    since = as_instant(as_of) - F.make_dt_interval(days=F.lit(days))
    kept = readings.filter(F.col("timestamp") >= since)
    if "event_day" in readings.columns:
        kept = kept.filter(F.col("event_day") >= utc_date(since))
    return kept


def of_type(readings: DataFrame, sensor_type: str) -> DataFrame:
    return readings.filter(F.col("sensor_type") == sensor_type)


def temperature_readings(readings: DataFrame) -> DataFrame:
    """Temperature readings, newest first."""
    wanted = of_type(readings, "temperature").select(
        "device_id", "sensor_type", "value", "timestamp"
    )
    return newest_first(wanted, ties=["device_id", "value"])


def hourly_temperature(
    readings: DataFrame, as_of: Column | str | None = None, days: int = 7
) -> DataFrame:
    """Temperature per UTC hour, device and location over the last days."""
    hourly = (
        recent(of_type(readings, "temperature"), days, as_of)
        .groupBy(utc_hour(F.col("timestamp")).alias("hour_bucket"), "device_id", "location")
        .agg(
            F.avg("value").alias("avg_temp"),
            F.min("value").alias("min_temp"),
            F.max("value").alias("max_temp"),
            F.count("*").alias("readings"),
        )
    )
    return hourly.orderBy(F.col("hour_bucket").desc(), "device_id", "location")


def device_sensor_stats(readings: DataFrame) -> DataFrame:
    """Mean and sample standard deviation per device and sensor over all history."""
    return readings.groupBy(*GROUP_KEY).agg(
        F.avg("value").alias("mean_val"),
        F.stddev_samp("value").alias("std_val"),
        F.count("*").alias("reading_count"),
    )


def anomalies(
    readings: DataFrame,
    threshold: float = 2.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    shares: int = SHARES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Readings further than ``threshold`` deviations from their group's mean.

    The statistics include the outliers, so a group of n readings has no z-score
    above (n - 1) / sqrt(n): none can pass 2 in a group of five or fewer.
    """
    with_stats = attach_group_rows(
        readings.dropna(subset=GROUP_KEY),
        device_sensor_stats(readings),
        GROUP_KEY,
        "reading_count",
        broadcast_bytes,
        shares,
        hot_rows,
    )
    return _by_z_score(with_stats, threshold)


def anomalies_windowed(
    readings: DataFrame,
    threshold: float = 2.0,
    shares: int = SHARES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`anomalies` with one shuffle of the readings and no statistics table.

    A window over the group holds all its rows in one task.  Groups too big for
    that are taken out first and meet their statistics, one row each, instead.
    """
    ordinary, hot = split_hot_groups(readings, GROUP_KEY, shares, hot_rows)
    group = Window.partitionBy(*GROUP_KEY)
    columns = [*readings.columns, "mean_val", "std_val"]
    with_stats = ordinary.select(
        "*",
        F.avg("value").over(group).alias("mean_val"),
        F.stddev_samp("value").over(group).alias("std_val"),
    ).select(*columns)
    if hot is not None:
        stats = device_sensor_stats(hot).drop("reading_count")
        with_stats = with_stats.unionByName(
            hot.join(F.broadcast(stats), GROUP_KEY).select(*columns)
        )
    return _by_z_score(with_stats, threshold)


def anomalies_view(readings: DataFrame, threshold: float = 2.0) -> DataFrame:
    """:func:`anomalies` as a plan alone, unordered: nothing is measured or written before it is read.

    For views, which have to show what is stored when they are queried. The
    planner chooses how the statistics reach the readings.
    """
    known = readings.dropna(subset=GROUP_KEY)
    stats = device_sensor_stats(known).drop("reading_count")
    return _beyond(known.join(stats, GROUP_KEY), threshold)


def anomalies_against(readings: DataFrame, stats: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Readings beyond ``threshold`` deviations from the mean their group has in ``stats``.

    ``stats`` has ``mean_val`` and ``std_val`` per device and sensor.  It is
    measured, and broadcast if it is small; the readings are then not shuffled.
    """
    known = stats.select(*GROUP_KEY, "mean_val", "std_val").dropna(subset=GROUP_KEY)
    side = F.broadcast(known) if table_bytes(known) <= BROADCAST_BYTES else known
    return _beyond(readings.dropna(subset=GROUP_KEY).join(side, GROUP_KEY), threshold)


def _beyond(with_stats: DataFrame, threshold: float) -> DataFrame:
    scored = with_stats.withColumn(
        "z_score", z_score(F.col("value"), F.col("mean_val"), F.col("std_val"))
    )
    return scored.filter(F.col("z_score") > threshold).select(*ANOMALY_COLUMNS)


def _by_z_score(with_stats: DataFrame, threshold: float) -> DataFrame:
    found = _beyond(with_stats, threshold)
    # Sorting samples its input, that is computes it twice; the few rows found
    # are written so that the second pass does not scan all readings again.
    return newest_first(written(found, "anomalies"), ties=[*GROUP_KEY, "value"])


def sensor_type_summary(readings: DataFrame) -> DataFrame:
    """Number of readings and mean value per sensor type."""
    return readings.groupBy("sensor_type").agg(
        F.count("*").alias("count"), F.avg("value").alias("avg")
    )


def latest_readings(readings: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest readings."""
    shown = readings.select("device_id", "sensor_type", "value", "timestamp")
    return top_newest(shown, n, ties=["device_id", "sensor_type", "value"])


def latest_windows(stats: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest rows of the window statistics."""
    return top_newest(stats, n, "window_start", ["device_id", "sensor_type", "location"])


def readings_per_partition(readings: DataFrame) -> DataFrame:
    """Row count of every (day, sensor type) partition of the reading table."""
    day = utc_date(F.col("timestamp"))
    return (
        readings.groupBy(day.alias("event_day"), "sensor_type")
        .agg(F.count("*").alias("readings"))
        .withColumn("day_number", day_number(F.col("event_day")))
    )


def threshold_alerts(current: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Current states whose value lies outside the limits of their sensor type."""
    low = high = F.lit(None).cast("double")
    for kind, (lowest, highest) in limits.items():
        low = F.when(F.col("sensor_type") == kind, F.lit(float(lowest))).otherwise(low)
        high = F.when(F.col("sensor_type") == kind, F.lit(float(highest))).otherwise(high)
    breach = F.when(F.col("current_value") < low, "below").when(
        F.col("current_value") > high, "above"
    )
    return current.withColumn("alert", breach).filter(F.col("alert").isNotNull())


def retained(readings: DataFrame, as_of: Column | str | None = None, days: int = 30) -> DataFrame:
    """Readings younger than ``days`` days at ``as_of``; older ones have expired."""
    age_limit = as_instant(as_of) - F.make_dt_interval(days=F.lit(days))
    kept = readings.filter(F.col("timestamp") > age_limit)
    if "event_day" in readings.columns:
        kept = kept.filter(F.col("event_day") >= utc_date(age_limit))
    return kept
