"""Catalog tables, created when missing, and views over the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from fieldpulse.operators.state import device_current
from fieldpulse.plans import reports
from fieldpulse.sources import tables
from fieldpulse.schema import MERGEABLE_STATS_DDL, STATE_DDL, STORED_READING_DDL

TABLES = {
    "sensor_readings": (STORED_READING_DDL + ", event_day DATE", "event_day, sensor_type"),
    "sensor_aggregations": (MERGEABLE_STATS_DDL + ", event_day DATE", "event_day"),
    "device_states": (STATE_DDL, "batch_id"),
}


def create_tables(spark: SparkSession, database: str = "default", provider: str = "parquet") -> None:
    """Create the tables that do not exist yet; existing ones keep their rows."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, partitioning) in TABLES.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
            f"USING {provider} PARTITIONED BY ({partitioning})"
        )


def register_views(
    readings: DataFrame, states: DataFrame, as_of: Column | str | None = None
) -> None:
    """Create or replace the report views over the given tables.

    Views are plans: over catalog tables they show what is stored when they are
    queried.
    """
    reports.hourly_temperature(readings, as_of).createOrReplaceTempView("hourly_temperature")
    reports.anomalies_view(readings).createOrReplaceTempView("anomalies")
    device_current(states).createOrReplaceTempView("device_current")


def register_stored_views(
    spark: SparkSession, root: str, as_of: Column | str | None = None
) -> None:
    """The report views over the tables a streaming job writes below ``root``.

    A view lists the batches when it is registered; call this again to see later
    ones, which costs a listing and reads no row.
    """
    readings = tables.read_readings(spark, f"{root}/readings")
    reports.hourly_temperature(readings, as_of).createOrReplaceTempView("hourly_temperature")
    reports.anomalies_view(readings).createOrReplaceTempView("anomalies")
    tables.read_device_current(spark, f"{root}/states").createOrReplaceTempView("device_current")
