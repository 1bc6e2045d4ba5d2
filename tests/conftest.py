from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

READING_DEFAULTS = {
    "device_id": "d1", "location": "roof", "device_type": "weather", "sensor_type": "temperature",
    "value": 20.0, "unit": "C", "timestamp": "2024-01-01 10:00:00", "quality": "good",
    "mqtt_topic": "sensors/temperature/d1", "ingest_time": "2024-01-02 00:00:00",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Builds readings from dicts that name only what differs from the default."""

    def build(*rows: dict):
        from pyspark.sql import functions as F

        from fieldpulse.schema import READING_FIELDS

        columns = [*READING_FIELDS, "ingest_time"]
        ddl = ", ".join(f"{c} {'DOUBLE' if c == 'value' else 'STRING'}" for c in columns)
        merged = [{**READING_DEFAULTS, **row} for row in rows]
        df = spark.createDataFrame([[row[c] for c in columns] for row in merged], ddl)
        return df.withColumns({
            c: F.col(c).cast("timestamp") for c in ("timestamp", "ingest_time")
        })

    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
