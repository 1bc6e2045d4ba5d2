"""Stored tables in the catalog, and persistent views over them.

The settled folders of a streaming job's tables are registered as partitions of external
tables, each folder under its ``layer``, the mark it was settled by. Which of them count
is a small table of its own, ``live_layers``, and every view keeps to it. Publishing adds
the new folders first and then points ``live_layers`` at a new list, in one step of the
catalog: a view shows the state before or the state after, never both or neither.

Views show what is published when they are read; rows of batches that are not settled yet
come with the next :func:`publish`. What only the list before last named leaves the
catalog then, so a query that was planned before a publish still finds its partitions;
vacuum the folders after publishing, with a time of grace.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from fieldpulse import storage
from fieldpulse.operators.key_filter import NO_VALUE
from fieldpulse.schema import MERGEABLE_STATS_DDL, STORED_READING_DDL
from fieldpulse.sources import batches, tables

#: Published tables: the columns, the partition columns with their types, the job's folder.
PARTITIONED = {
    "stored_readings": (STORED_READING_DDL, {"event_day": "DATE", "sensor_type": "STRING"}, "readings"),
    "stored_window_stats": (MERGEABLE_STATS_DDL, {"event_day": "DATE"}, "window_stats"),
}
LIVE_DDL = "name STRING, layer BIGINT, event_day DATE, sensor_type STRING"
#: Partitions registered by one statement.
AT_ONCE = 200

_MICROS_PER_HOUR = 3_600_000_000
_MICROS_PER_DAY = 24 * _MICROS_PER_HOUR


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create(spark: SparkSession, root: str, database: str, as_of: str | None = None) -> None:
    """Create the tables and views over the job's tables below ``root`` that are missing.

    ``as_of`` fixes the time of views that look back from now.
    """
    base = f"{root}/published"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_quoted(f'{base}/database')}")
    for name, (ddl, partitions, _) in PARTITIONED.items():
        plain = ", ".join(c for c in ddl.split(", ") if c.split()[0] not in partitions)
        typed = "".join(f", {column} {kind}" for column, kind in partitions.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({plain}, layer BIGINT{typed}) USING parquet "
            f"PARTITIONED BY (layer, {', '.join(partitions)}) LOCATION {_quoted(f'{base}/{name}')}"
        )
    for name, ddl in (("live_layers", LIVE_DDL), ("stored_states", tables.PARTIAL_DDL)):
        columns = ddl.replace(": ", ":")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
            f"LOCATION {_quoted(f'{base}/{name}/none')}"
        )
    for name, text in views(database, as_of).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")


def views(database: str, as_of: str | None = None) -> dict[str, str]:
    """The views' SQL: stored readings and windows, and the reports over them."""
    now = f"TIMESTAMP {_quoted(as_of)}" if as_of else "current_timestamp()"

    def live(name: str) -> str:
        ddl, partitions, _ = PARTITIONED[name]
        columns = ", ".join(f"t.{c}" for c in dict.fromkeys([*StructType.fromDDL(ddl).names, *partitions]))
        same = " AND ".join(f"t.{column} <=> l.{column}" for column in partitions)
        return (
            f"SELECT {columns} FROM {database}.{name} t LEFT SEMI JOIN {database}.live_layers l "
            f"ON l.name = '{name}' AND t.layer = l.layer AND {same}"
        )

    since_day = f"date_from_unix_date(CAST(floor(unix_micros({now}) / {_MICROS_PER_DAY}) AS INT) - 7)"
    z_score = "abs(r.value - s.mean_val) / nullif(s.std_val, 0)"
    return {
        "readings": live("stored_readings"),
        "window_stats": live("stored_window_stats"),
        "device_current": f"""
            SELECT device_id, sensor_type, location, latest.value AS current_value, latest.timestamp AS last_seen,
              max_value, min_value, total_readings
            FROM {database}.stored_states""",
        "hourly_temperature": f"""
            SELECT timestamp_micros(unix_micros(timestamp) - pmod(unix_micros(timestamp), {_MICROS_PER_HOUR})) AS hour_bucket,
              device_id, location, avg(value) AS avg_temp, min(value) AS min_temp, max(value) AS max_temp,
              count(*) AS readings
            FROM {database}.readings
            WHERE sensor_type = 'temperature' AND event_day >= {since_day} AND timestamp >= {now} - INTERVAL 7 DAYS
            GROUP BY 1, 2, 3""",
        "anomalies": f"""
            SELECT r.device_id, r.sensor_type, r.location, r.value, s.mean_val, s.std_val, {z_score} AS z_score, r.timestamp
            FROM {database}.readings r JOIN (
              SELECT device_id, sensor_type, avg(value) AS mean_val, stddev_samp(value) AS std_val
              FROM {database}.readings GROUP BY device_id, sensor_type) s
            ON r.device_id = s.device_id AND r.sensor_type = s.sensor_type
            WHERE {z_score} > 2""",
    }


def _spec(mark: int, place: str) -> dict[str, str | None]:
    """A partition folder's values by column, as text; None for the folder of rows without one."""
    steps = [step.partition("=")[::2] for step in place.split("/")]
    values = {column: None if value == NO_VALUE else unquote(value) for column, value in steps}
    return {"layer": str(mark), **values}


def _live(spark: SparkSession, root: str) -> dict[str, dict[tuple, str]]:
    """Per published table the live folders by the values of their partition columns."""
    found: dict[str, dict[tuple, str]] = {}
    for name, (_, partitions, folder) in PARTITIONED.items():
        depth = len(partitions)
        layers = batches.live_folders(spark, f"{root}/{folder}", depth)
        found[name] = {
            tuple(_spec(batches.mark_of(path, depth), place).items()): path
            for place, paths in layers.items() for path in paths
        }
    return found


def _partition(spec: tuple) -> str:
    values = ", ".join(f"{column} = {'NULL' if value is None else _quoted(value)}" for column, value in spec)
    return f"PARTITION ({values})"


def _registered(spark: SparkSession, database: str, name: str) -> set[tuple]:
    found = spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()
    specs = set()
    for row in found:
        layer, _, place = row["partition"].partition("/")
        specs.add(tuple(_spec(int(layer.partition("=")[2]), place).items()))
    return specs


def publish(spark: SparkSession, root: str, database: str) -> int:
    """Show what is settled below ``root``; returns the number of live partitions.

    A run that dies half way leaves the views as they were.
    """
    live = _live(spark, root)
    before = {
        (row["name"], row["layer"], None if row["event_day"] is None else str(row["event_day"]), row["sensor_type"])
        for row in spark.table(f"{database}.live_layers").collect()
    }
    for name, specs in live.items():
        missing = sorted(specs.keys() - _registered(spark, database, name), key=str)
        for start in range(0, len(missing), AT_ONCE):
            added = " ".join(f"{_partition(s)} LOCATION {_quoted(specs[s])}" for s in missing[start:start + AT_ONCE])
            spark.sql(f"ALTER TABLE {database}.{name} ADD IF NOT EXISTS {added}")
        spark.catalog.refreshTable(f"{database}.{name}")
    rows = [
        (name, int(spec["layer"]), spec["event_day"], spec.get("sensor_type"))
        for name, specs in live.items() for spec in map(dict, specs)
    ]
    listed = spark.createDataFrame(rows, "name STRING, layer BIGINT, event_day STRING, sensor_type STRING")
    target = f"{root}/published/live_layers/{uuid.uuid4().hex}"
    listed.withColumn("event_day", listed["event_day"].cast("date")).write.parquet(target)
    _point(spark, f"{database}.live_layers", target)
    if marks := batches.settled_marks(spark, f"{root}/states"):
        _point(spark, f"{database}.stored_states", f"{root}/states/settled/upto={marks[-1]}")
    for name, specs in live.items():
        dead = sorted((
            spec for spec in _registered(spark, database, name) - specs.keys()
            if (name, *_listed(spec)) not in before
        ), key=str)
        for start in range(0, len(dead), AT_ONCE):
            dropped = ", ".join(map(_partition, dead[start:start + AT_ONCE]))
            spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS {dropped}")
    return len(rows)


def _listed(spec: tuple) -> tuple:
    values = dict(spec)
    return int(values["layer"]), values["event_day"], values.get("sensor_type")


def _point(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(folder)}")
    spark.catalog.refreshTable(table)


def clear_lists(spark: SparkSession, root: str, database: str) -> None:
    """Delete the lists that ``live_layers`` has no use for any more; run it when no old reader is left."""
    used = spark.sql(f"DESCRIBE FORMATTED {database}.live_layers").filter("col_name = 'Location'").first()["data_type"]
    for name in storage.child_folders(spark, f"{root}/published/live_layers"):
        if name not in ("none", used.rpartition("/")[2]):
            storage.delete(spark, f"{root}/published/live_layers/{name}")
