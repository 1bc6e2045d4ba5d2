"""What happens to the rows of a micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from fieldpulse.operators import quality
from fieldpulse.schema import READING_CONTRACT, ColumnRule
from fieldpulse.sources import tables

WriteBatch = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Sink:
    """A named writer of micro-batches.

    ``format`` is the data source the writer needs, to be checked at the start.
    ``wants_payload`` asks for the message a reading came from, as ``payload``.
    ``merges_windows`` says that a row for a window that is there corrects it.
    """

    name: str
    write: WriteBatch
    format: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    wants_payload: bool = False
    merges_windows: bool = False

    def check(self, spark: SparkSession) -> None:
        """Fail now rather than in the middle of a batch if the format or its driver is missing."""
        if self.format is None:
            return
        driver = self.options.get("driver")
        if driver:
            loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
            try:
                loader.loadClass(driver)
            except Exception as error:
                raise ValueError(
                    f"sink {self.name!r}: driver {driver!r} is not on the class path"
                ) from error
        lookup = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
        try:
            lookup.lookupDataSource(self.format, spark._jsparkSession.sessionState().conf())
        except Exception as error:
            raise ValueError(
                f"sink {self.name!r}: data source {self.format!r} is not on the class path"
            ) from error


def readings_sink(path: str, name: str = "readings") -> Sink:
    """The readings table; a retried batch replaces itself."""
    return Sink(name, lambda rows, batch_id: tables.append_readings(rows, path, batch_id))


def states_sink(path: str, name: str = "states") -> Sink:
    """Partial states of each batch, the increments of the current-state table."""
    return Sink(name, lambda rows, batch_id: tables.append_states(rows, path, batch_id))


def window_stats_sink(path: str, name: str = "window_stats") -> Sink:
    """The window-statistics table; late moments of a closed window correct it."""
    return Sink(
        name, lambda rows, batch_id: tables.append_window_stats(rows, path, batch_id), merges_windows=True
    )


def late_sink(path: str, name: str = "late") -> Sink:
    """Readings that came after their window had closed, with the ``watermark`` they missed."""
    return Sink(name, lambda rows, batch_id: tables.append_late(rows, path, batch_id))


def current_sink(path: str, name: str = "current") -> Sink:
    """The states that a batch changed; each replaces the one before."""
    return Sink(name, lambda rows, batch_id: tables.append_current(rows, path, batch_id))


def anomalies_sink(path: str, name: str = "anomalies") -> Sink:
    """Readings far from their group's mean, as it was when they came."""
    return Sink(name, lambda rows, batch_id: tables.append_anomalies(rows, path, batch_id))


def rejects_sink(path: str, name: str = "rejects") -> Sink:
    """Refused messages with their reason, one folder per batch."""
    return Sink(
        name, lambda rows, batch_id: tables.append_rejects(rows, path, batch_id), wants_payload=True
    )


def format_sink(
    name: str, format: str, options: dict[str, str], mode: str = "append"
) -> Sink:
    """Any Spark data source.  Appends are repeated when a batch is retried, so
    the target should replace by key, as a versioned table does."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format(format).options(**options).mode(mode).save()

    return Sink(name, write, format, options)


def jdbc_sink(
    name: str,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    batch_rows: int = 50_000,
    connections: int = 8,
) -> Sink:
    """A database table over JDBC, written over at most so many ``connections``."""
    return format_sink(name, "jdbc", {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "batchsize": str(batch_rows), "numPartitions": str(connections),
    })


def dead_letter_sink(target: Sink) -> Sink:
    """Refused messages as records of a log: their payload, keyed by the reason."""

    def write(rows: DataFrame, batch_id: int) -> None:
        target.write(rows.selectExpr("reject_reason AS key", "payload AS value"), batch_id)

    return replace(target, write=write, wants_payload=True)


def columns_sink(target: Sink, columns: list[str]) -> Sink:
    """``target`` for a table that has these columns and no others."""
    return replace(target, write=lambda rows, batch_id: target.write(rows.select(*columns), batch_id))


def topic_sink(name: str, servers: str, topic: str) -> Sink:
    """Rows with ``key`` and ``value`` to a Kafka topic."""
    return format_sink(name, "kafka", {"kafka.bootstrap.servers": servers, "topic": topic})


def checked_sink(
    target: Sink, refused: Sink, contract: dict[str, ColumnRule] = READING_CONTRACT
) -> Sink:
    """``target`` for a strict table: rows that break its constraints go to ``refused``.

    Their ``reject_reason`` lists the constraints, and they keep their payload.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        write_all(quality.conforming(rows, contract), batch_id, [target])
        broken = quality.violating(rows, contract)
        write_all(broken.withColumnRenamed("violations", "reject_reason"), batch_id, [refused])

    return replace(target, write=write, wants_payload=True)


def write_all(rows: DataFrame, batch_id: int, sinks: list[Sink]) -> None:
    """Write a batch to each sink in turn, to none if it has no rows."""
    if sinks and not rows.isEmpty():
        for sink in sinks:
            sink.write(rows if sink.wants_payload else rows.drop("payload"), batch_id)
