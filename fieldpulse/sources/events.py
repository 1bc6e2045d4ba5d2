"""Sensor readings and messages derived from an ``events`` table.

Used to run the operators on a generic event log: every event becomes one
reading of one of five devices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldpulse.operators.ingest import readings_to_json

# --- Fixed values -----------------------------------------------------------

DEVICES = {
    "device-001": ("factory-floor-A", "industrial"),
    "device-002": ("factory-floor-B", "industrial"),
    "device-003": ("warehouse-1", "environmental"),
    "device-004": ("warehouse-2", "environmental"),
    "device-005": ("rooftop", "weather"),
}
SENSOR_OF_EVENT = {
    "view": "temperature",
    "click": "humidity",
    "purchase": "pressure",
    "error": "vibration",
    "signup": "co2",
}
UNITS = {"temperature": "°C", "humidity": "%", "pressure": "hPa", "vibration": "g"}

EPOCH_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
INGEST_MICROS = EPOCH_MICROS + 60 * 86_400_000_000
DENSE_FACTOR = 360  # 30 days of events into 2 hours

# The zone-less timestamps of the file are read as instants in UTC.
EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def _lookup(key: Column, table: dict[str, str]) -> Column:
    # A literal map, not a CASE: filters repeat the expression, and long ones
    # make generated methods too big for the JVM to compile.
    pairs = [F.lit(text) for pair in table.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def event_k() -> Column:
    """The number in ``props``, which is always ``{"k": <number>}``."""
    return F.regexp_extract("props", r"(\d+)", 1).try_cast("int")


def readings_from_events(events: DataFrame, dense: bool = False, keep: list[str] = ()) -> DataFrame:
    """One reading per event, with ``ingest_time``.

    ``dense`` compresses time so that 5-minute groups have many readings.
    ``keep`` names event columns to carry along.
    """
    number = (F.pmod("user_id", F.lit(5)) + 1).cast("string")
    device = F.concat(F.lit("device-"), F.lpad(number, 3, "0"))
    k = event_k()
    time = F.col("ts")
    if dense:
        since = F.unix_micros("ts") - EPOCH_MICROS
        whole = (since - F.pmod(since, F.lit(DENSE_FACTOR))) / F.lit(DENSE_FACTOR)
        time = F.timestamp_micros(F.lit(EPOCH_MICROS) + whole.cast("bigint"))
    base = events.select(
        *keep,
        device.alias("device_id"),
        _lookup(F.col("event_type"), SENSOR_OF_EVENT).alias("sensor_type"),
        F.when(F.col("event_type") == "purchase", F.col("value") + 950)
        .otherwise(F.col("value")).alias("value"),
        time.alias("timestamp"),
        F.when(k < 5, "uncertain").otherwise("good").alias("quality"),
        F.timestamp_micros(F.lit(INGEST_MICROS) + F.col("event_id") * 1000).alias("ingest_time"),
    )
    return base.select(
        *keep,
        "device_id",
        _lookup(F.col("device_id"), {d: place for d, (place, _) in DEVICES.items()})
        .alias("location"),
        _lookup(F.col("device_id"), {d: kind for d, (_, kind) in DEVICES.items()})
        .alias("device_type"),
        "sensor_type",
        "value",
        _lookup(F.col("sensor_type"), UNITS).alias("unit"),
        "timestamp",
        "quality",
        F.concat_ws("/", F.lit("sensors"), "sensor_type", "device_id").alias("mqtt_topic"),
        "ingest_time",
    )


def messages_from_events(events: DataFrame, dense: bool = False, keep: list[str] = ()) -> DataFrame:
    """Events as topic records: ``key``, ``value`` (JSON bytes), ``topic``, ``ingest_time``."""
    readings = readings_from_events(events, dense, keep)
    payload = readings_to_json(readings)
    return readings.select(
        *keep,
        F.col("mqtt_topic").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.col("mqtt_topic").alias("topic"),
        "ingest_time",
    )
