"""History through a streaming query, in steps of time.

A stream over stored files takes them in no order of time: taken in several batches, the
watermark of one drops rows of the next as late; taken in one, the batch has no bound. Here
the rows are first written in ranges of time, and the query is run once per range, on from
its checkpoint. Every range is a batch of bounded size, and none holds a row behind the
watermark of the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldpulse import storage
from fieldpulse.operators import quality

#: How exact the bounds of the ranges are, as a share of the rows.
ACCURACY = 10_000


def stage_by_time(rows: DataFrame, path: str, steps: int, time: str = "timestamp") -> int:
    """Write ``rows`` below ``path`` in up to ``steps`` ranges of ``time`` with about as many rows each.

    Rows without a time come with the first range; rows of one instant stay together.
    Staging again replaces what has not entered a query. Returns the number of ranges.
    """
    micros = F.unix_micros(time)
    shares = [n / steps for n in range(1, steps)]
    bounds = rows.agg(F.percentile_approx(micros, F.array(*map(F.lit, shares)), ACCURACY)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    step = sum((F.coalesce(micros > bound, F.lit(False)).cast("int") for bound in bounds), F.lit(0))
    numbered = rows.withColumn("step", step)
    arranged = numbered.hint("rebalance", "step").sortWithinPartitions("step", time)
    arranged.write.mode("overwrite").partitionBy("step").parquet(f"{path}/staged")
    return len(bounds) + 1


def waiting_steps(spark: SparkSession, path: str) -> list[int]:
    """The ranges that have not entered a query yet, oldest first."""
    return storage.numbered_folders(spark, f"{path}/staged", "step")


def run_steps(
    spark: SparkSession, path: str, schema: StructType | str, start: Callable[[DataFrame], StreamingQuery]
) -> int:
    """Run the query that ``start`` makes of a stream, once per staged range, in order of time.

    ``schema`` is that of the staged rows. ``start`` has to give a query that takes what is there and
    ends, always with the same checkpoint. After a failure, call this again: the ranges that
    entered are finished first, the others follow. Returns how many ranges entered.
    """
    source = f"{path}/entered"

    def run() -> None:
        stream = spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{source}/*")
        start(stream).awaitTermination()

    if storage.child_folders(spark, source):
        run()
    waiting = waiting_steps(spark, path)
    for step in waiting:
        storage.move(spark, f"{path}/staged/step={step}", f"{source}/{step:06d}")
        run()
    return len(waiting)


def window_stats_backfill(
    spark: SparkSession, messages: DataFrame, path: str, steps: int, start: Callable[[DataFrame], StreamingQuery]
) -> int:
    """Stored messages through the window statistics: classified once, staged by time, run in steps.

    ``start`` gets a stream of accepted readings, as :func:`jobs.start_window_stats` takes it.
    """
    clean = quality.accepted(quality.classify_messages(messages, keep=["ingest_time"]))
    stage_by_time(clean, path, steps)
    return run_steps(spark, path, clean.schema, start)
