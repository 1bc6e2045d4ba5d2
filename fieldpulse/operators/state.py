"""Current state per device and sensor from mergeable partial states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.schema import STATE_KEY


def partial_states(readings: DataFrame, batch_id: Column | int, by: list[str] = STATE_KEY) -> DataFrame:
    """One state row per batch and group: latest reading, max, min, count.

    ``batch_id`` is a number, or a column when ``readings`` spans many batches.
    ``latest`` compares time, then ingest time, then value.
    """
    column = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
    states = readings.groupBy(column.cast("bigint").alias("batch_id"), *by).agg(*_states())
    return states.select(*by, "latest", "max_value", "min_value", "total_readings", "batch_id")


def _states() -> list[Column]:
    return [
        F.max(F.struct("timestamp", "ingest_time", "value")).alias("latest"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.count("*").alias("total_readings"),
    ]


def current_states(readings: DataFrame, by: list[str] = STATE_KEY) -> DataFrame:
    """The state of each group over all readings, also of a stream."""
    return readings.groupBy(*by).agg(*_states())


def merge_states(states: DataFrame, by: list[str] = STATE_KEY) -> DataFrame:
    """Partial states of equal group merged; merging again changes nothing."""
    return states.groupBy(*by).agg(
        F.max("latest").alias("latest"),
        F.max("max_value").alias("max_value"),
        F.min("min_value").alias("min_value"),
        F.sum("total_readings").alias("total_readings"),
    )


def present_states(merged: DataFrame, by: list[str] = STATE_KEY) -> DataFrame:
    """Merged states as current value, time last seen, extremes and count."""
    return merged.select(
        *by,
        F.col("latest.value").alias("current_value"),
        F.col("latest.timestamp").alias("last_seen"),
        "max_value",
        "min_value",
        "total_readings",
    )


def device_current(states: DataFrame, by: list[str] = STATE_KEY) -> DataFrame:
    """The current state per group from any set of partial states."""
    return present_states(merge_states(states, by), by)
