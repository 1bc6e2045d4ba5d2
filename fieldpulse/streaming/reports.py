"""What every micro-batch did, written by a listener beside the queries.

A report is a small file named by query and batch, so a batch that is reported again
replaces its report. :func:`gather` turns files into a Parquet table now and then.
"""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fieldpulse import storage

REPORT_DDL = (
    "query_id STRING, batch_id BIGINT, triggered TIMESTAMP, name STRING, run_id STRING, input_rows BIGINT, "
    "late_groups BIGINT, watermark TIMESTAMP, state_rows BIGINT, state_bytes BIGINT, milliseconds BIGINT"
)

log = logging.getLogger(__name__)


def as_report(progress) -> dict:
    """One batch's report from a query's progress.

    ``input_rows`` counts what was read, twice where a query reads its source twice.
    ``late_groups`` counts what the aggregation dropped, after tasks had combined rows.
    """
    operators = progress.stateOperators
    return {
        "query_id": str(progress.id), "batch_id": progress.batchId, "triggered": progress.timestamp,
        "name": progress.name, "run_id": str(progress.runId), "input_rows": progress.numInputRows,
        "late_groups": sum(o.numRowsDroppedByWatermark for o in operators),
        "watermark": dict(progress.eventTime or {}).get("watermark"),
        "state_rows": sum(o.numRowsTotal for o in operators),
        "state_bytes": sum(o.memoryUsedBytes for o in operators),
        "milliseconds": dict(progress.durationMs or {}).get("triggerExecution"),
    }


class BatchReports(StreamingQueryListener):
    """Writes a report of every batch below ``path``; attach it to the session's streams.

    Reports come after their batches, from Spark's listener thread; a query never
    waits for them, and a report that cannot be written is logged and left out.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def attach(self) -> BatchReports:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(event.runId)

    def onQueryProgress(self, event) -> None:
        report = as_report(event.progress)
        file = f"{self.path}/reported/{report['query_id']}-{report['batch_id']:012d}.json"
        try:
            storage.write_text(self.spark, file, json.dumps(report))
        except Exception:  # the stream goes on without its report
            log.exception("no report of %s, batch %s", report["name"], report["batch_id"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all reports of a query that has ended are written; False if it took too long."""
        return self._end_of(query.runId).wait(seconds)


def _gathered(spark: SparkSession, path: str) -> list[str]:
    marks = storage.matching(spark, f"{path}/gathered/run=*/_SUCCESS")
    return [mark.rpartition("/")[0] for mark in marks]


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch, the last report of each."""
    rows = spark.createDataFrame([], REPORT_DDL)
    if storage.matching(spark, f"{path}/reported/*.json"):
        rows = rows.unionByName(spark.read.schema(REPORT_DDL).json(f"{path}/reported/*.json"))
    if folders := _gathered(spark, path):
        rows = rows.unionByName(spark.read.schema(REPORT_DDL).parquet(*folders))
    rest = [name for name in rows.columns if name not in ("query_id", "batch_id")]
    last = rows.groupBy("query_id", "batch_id").agg(F.max(F.struct(*rest)).alias("last"))
    return last.select("query_id", "batch_id", "last.*")


def gather(spark: SparkSession, path: str) -> int:
    """Move the reports that are there into a Parquet folder; returns how many.

    A run that dies half way leaves some in both places, where they count once.
    """
    files = storage.matching(spark, f"{path}/reported/*.json")
    if files:
        number = max(storage.numbered_folders(spark, f"{path}/gathered", "run"), default=-1) + 1
        rows = spark.read.schema(REPORT_DDL).json(files)
        rows.hint("rebalance").write.parquet(f"{path}/gathered/run={number}")
    for file in files:
        storage.delete(spark, file)
    return len(files)
