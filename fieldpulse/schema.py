"""Column contracts shared by the operators: readings, statistics, states."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values (names, types, limits that define the data model) ---------

READING_DDL = (
    "device_id STRING, location STRING, device_type STRING, sensor_type STRING, "
    "value DOUBLE, unit STRING, timestamp TIMESTAMP, quality STRING, mqtt_topic STRING"
)
READING_FIELDS = [column.split()[0] for column in READING_DDL.split(", ")]
STORED_READING_DDL = READING_DDL + ", ingest_time TIMESTAMP"
REJECT_DDL = STORED_READING_DDL + ", payload STRING, reject_reason STRING"

WINDOW_STATS_DDL = (
    "window_start TIMESTAMP, window_end TIMESTAMP, device_id STRING, sensor_type STRING, "
    "location STRING, avg_value DOUBLE, min_value DOUBLE, max_value DOUBLE, "
    "stddev_value DOUBLE, reading_count BIGINT"
)
# What a stored row needs to be merged into longer windows.
MERGEABLE_STATS_DDL = WINDOW_STATS_DDL + ", value_count BIGINT, mean DOUBLE, m2 DOUBLE"
WINDOW_STATS_COLUMNS = [column.split()[0] for column in WINDOW_STATS_DDL.split(", ")]

STATE_DDL = (
    "device_id STRING, sensor_type STRING, location STRING, "
    "latest STRUCT<timestamp: TIMESTAMP, ingest_time: TIMESTAMP, value: DOUBLE>, "
    "max_value DOUBLE, min_value DOUBLE, total_readings BIGINT, batch_id BIGINT"
)

# A group's statistics in mergeable form, and what lies far from them.
MOMENTS_DDL = (
    "device_id STRING, sensor_type STRING, reading_count BIGINT, value_count BIGINT, mean DOUBLE, "
    "m2 DOUBLE, min_value DOUBLE, max_value DOUBLE"
)
ANOMALY_DDL = (
    "device_id STRING, sensor_type STRING, location STRING, value DOUBLE, mean_val DOUBLE, "
    "std_val DOUBLE, z_score DOUBLE, timestamp TIMESTAMP"
)

READING_KEY = ["device_id", "sensor_type", "timestamp"]
GROUP_KEY = ["device_id", "sensor_type"]
STATE_KEY = ["device_id", "sensor_type", "location"]
WINDOW_KEY = ["window_start", "window_end", "device_id", "sensor_type", "location"]

GOOD_QUALITY = "good"

# Plausible value range per sensor type, inclusive at both ends.
PLAUSIBLE_RANGES: dict[str, tuple[float, float]] = {
    "temperature": (-40.0, 125.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
    "vibration": (0.0, 50.0),
}


@dataclass(frozen=True)
class ColumnRule:
    """A warehouse column constraint: longest text allowed, NULL allowed or not."""

    max_length: int | None = None
    required: bool = False


READING_CONTRACT: dict[str, ColumnRule] = {
    "device_id": ColumnRule(64, required=True),
    "location": ColumnRule(128),
    "device_type": ColumnRule(64),
    "sensor_type": ColumnRule(64, required=True),
    "value": ColumnRule(required=True),
    "unit": ColumnRule(16),
    "timestamp": ColumnRule(required=True),
    "quality": ColumnRule(32),
    "mqtt_topic": ColumnRule(256),
}
