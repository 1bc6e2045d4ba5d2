"""The streaming queries and their supervision."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldpulse import storage
from fieldpulse.operators import quality
from fieldpulse.operators.episodes import episodes, last_runs, merge_runs, signal_runs
from fieldpulse.operators.ingest import classify_forwarding, filter_topics, keyed_records
from fieldpulse.operators.latest import drop_redelivered
from fieldpulse.operators.state import current_states, present_states
from fieldpulse.operators.windows import WINDOW, present_moments, window_moments
from fieldpulse.plans.reports import anomalies_against
from fieldpulse.schema import GROUP_KEY, STATE_DDL, STATE_KEY
from fieldpulse.sources import batches, tables
from fieldpulse.streaming.sinks import Sink, write_all

WATERMARK = "2 minutes"

log = logging.getLogger(__name__)


def start_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    counted: bool = True,
) -> StreamingQuery:
    """Run ``write`` on each non-empty micro-batch of ``rows``.

    ``every`` is the trigger interval; without it the query takes what is there
    and ends.  The batch is computed once, by the count that is logged, and kept
    for all that ``write`` does with it.  Not ``counted``, it is computed by what
    ``write`` does first; batch reports (:mod:`fieldpulse.streaming.reports`) have
    its rows without a job of their own.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if counted:
                count = batch.count()
                log.info("%s, batch %s: %s rows", name, batch_id, count)
            if not counted or count:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    timing = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .foreachBatch(handle)
        .start()
    )


def start_readings(
    messages: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    reject_sinks: list[Sink] = (),
    every: str | None = None,
    name: str = "readings",
    clock_allowance: str | None = None,
    keep: list[str] = (),
    counted: bool = True,
) -> StreamingQuery:
    """Parse, validate and store messages; rejected ones go to their own sinks."""
    _check(messages.sparkSession, [*sinks, *reject_sinks])
    classified = quality.classify_messages(
        messages, keep=keep, clock_allowance=clock_allowance
    )
    if not any(sink.wants_payload for sink in [*sinks, *reject_sinks]):
        classified = classified.drop("payload")  # not kept with the batch for nobody

    def route(batch: DataFrame, batch_id: int) -> None:
        write_all(quality.accepted(batch, keep_payload=True), batch_id, sinks)
        write_all(quality.rejected(batch), batch_id, reject_sinks)

    return start_batches(classified, route, name, checkpoint, every, counted=counted)


def start_window_stats(
    readings: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    every: str | None = None,
    name: str = "window_stats",
    window: str = WINDOW,
    watermark: str = WATERMARK,
    first_deliveries_only: bool = False,
    correct: bool = False,
    late_sinks: list[Sink] = (),
    counted: bool = True,
) -> StreamingQuery:
    """Statistics per window, written once when the watermark has closed it.

    Rows for closed windows are dropped and counted in the query's progress as
    ``numRowsDroppedByWatermark``.  An idle source closes nothing.
    ``first_deliveries_only`` counts a message that arrives again within the
    watermark once, at the price of state for every reading of that time.

    ``correct`` gives the moments of late rows to the sinks that merge windows, in
    the batch that dropped them; the others keep the window as it was closed.
    ``late_sinks`` get the late readings themselves.  Either reads the source a
    second time within the query, for the rows beside the aggregate.
    """
    _check(readings.sparkSession, [*sinks, *late_sinks])
    routed = correct or bool(late_sinks)
    if first_deliveries_only:
        if routed:
            raise ValueError("late rows cannot be told from redeliveries: route them or drop redeliveries")
        readings = drop_redelivered(readings, watermark)
        watermark = None
    stats = present_moments(
        window_moments(readings, window, watermark=watermark), keep_moments=True
    )
    if not routed:
        return start_batches(
            stats, lambda batch, n: write_all(batch, n, sinks), name, checkpoint, every, counted=counted
        )
    closed = F.struct(*stats.columns)
    row = F.struct(*readings.columns)
    null = lambda struct, of: F.lit(None).cast(of.select(struct).schema[0].dataType)
    both = stats.select(closed.alias("closed"), null(row, readings).alias("row")).unionByName(
        readings.select(null(closed, stats).alias("closed"), row.alias("row"))
    )

    def route(batch: DataFrame, batch_id: int) -> None:
        at_close = batch.filter(F.col("closed").isNotNull()).select("closed.*")
        passed = late_watermark(batch.sparkSession, checkpoint, batch_id)
        rows = batch.filter(F.col("row").isNotNull()).select("row.*")
        late = rows.filter(F.window("timestamp", window).getField("end") <= passed)
        moments = present_moments(window_moments(late, window), keep_moments=True)
        merging = [sink for sink in sinks if correct and sink.merges_windows]
        write_all(at_close.unionByName(moments), batch_id, merging)
        write_all(at_close, batch_id, [sink for sink in sinks if sink not in merging])
        write_all(late.withColumn("watermark", passed), batch_id, late_sinks)

    return start_batches(both, route, name, checkpoint, every, counted=counted)


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """The watermark behind which an aggregation drops rows in this batch.

    It is the one the batch before closed windows by, as committed to the
    checkpoint; so a batch that is repeated after a failure finds the same rows late.
    """
    several = spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"
    decisive = batch_id - 1 if several else batch_id
    if decisive < 0:
        return F.timestamp_millis(F.lit(0))
    offsets = storage.read_text(spark, f"{checkpoint}/offsets/{decisive}")
    return F.timestamp_millis(F.lit(json.loads(offsets.split("\n")[1])["batchWatermarkMs"]))


def start_current(
    readings: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    every: str | None = None,
    name: str = "current",
    counted: bool = True,
) -> StreamingQuery:
    """The current state per group, kept by the stream; sinks get the groups a batch changed.

    The state holds one row per device, sensor and location, and each row that
    leaves is that group's whole state: writing it again changes nothing.
    """
    _check(readings.sparkSession, sinks)
    return start_batches(
        current_states(readings), lambda batch, n: write_all(batch, n, sinks), name, checkpoint, every,
        mode="update", counted=counted,
    )


def state_of_current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state store of :func:`start_current` holds now, in the form of the stored states."""
    measures = ", ".join(
        f"{field.name}: {field.dataType.simpleString()}"
        for field in StructType.fromDDL(STATE_DDL) if field.name not in [*STATE_KEY, "batch_id"]
    )
    stored = spark.read.format("statestore").load(checkpoint)
    return stored.select("key.*", F.col("value").cast(f"struct<{measures}>").alias("value")).select(
        *STATE_KEY, "value.*"
    )


def current_beside_state(spark: SparkSession, checkpoint: str, path: str) -> DataFrame:
    """Every group's stored state with ``agrees``: whether the stream's own state is the same.

    The two are written one after the other, so a difference that stays once the
    stream has ended means that a batch did not reach the table.
    """
    state = present_states(state_of_current(spark, checkpoint))
    measures = [name for name in state.columns if name not in STATE_KEY]
    side = lambda rows, name: rows.select(*STATE_KEY, F.struct(*measures).alias(name))
    a, b = side(tables.read_current(spark, path), "stored").alias("a"), side(state, "held").alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")) for name in STATE_KEY])
    return a.join(b, same, "full").select(
        *[F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in STATE_KEY],
        "stored.*", F.col("stored").eqNullSafe(F.col("held")).alias("agrees"),
    )


def start_anomalies(
    readings: DataFrame,
    moments: str,
    sinks: list[Sink],
    checkpoint: str,
    threshold: float = 2.0,
    every: str | None = None,
    name: str = "anomalies",
    counted: bool = True,
) -> StreamingQuery:
    """Readings far from the mean of their device and sensor, judged when they come.

    A batch first adds its moments to the table at ``moments``, then its readings
    meet the statistics of all batches up to it.  History is not read again, and a
    batch that is repeated replaces its moments and finds the same.
    """
    _check(readings.sparkSession, sinks)

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        if len(batches.fresh_batches(spark, moments)) > tables.MOMENT_BATCHES:
            tables.settle_group_moments(spark, moments)
            batches.vacuum(spark, moments, cumulative=True, grace_seconds=tables.GRACE.total_seconds())
        tables.append_group_moments(batch, moments, batch_id)
        stats = tables.read_group_stats(spark, moments)
        write_all(anomalies_against(batch, stats, threshold), batch_id, sinks)

    return start_batches(readings, judge, name, checkpoint, every, counted=counted)


def start_alerts(
    readings: DataFrame,
    path: str,
    limits: dict[str, tuple[float, float]],
    checkpoint: str,
    margin: float = 0.1,
    late_sinks: list[Sink] = (),
    every: str | None = None,
    name: str = "alerts",
    counted: bool = True,
) -> StreamingQuery:
    """Alert episodes kept over batches: each is raised once, and ends once.

    The table at ``path`` has the episodes that ended and the run every group is in.
    Readings not after what their group was last judged by change nothing any more;
    the ``late_sinks`` get them.  A repeated batch starts from the same runs.
    """
    _check(readings.sparkSession, late_sinks)

    def judge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        before = tables.read_alert_runs(batch.sparkSession, path, batch_id)
        judged = before.select(*GROUP_KEY, F.col("last").alias("judged"))
        met = batch.join(judged, GROUP_KEY, "left")
        place = F.struct("timestamp", "ingest_time", "value")
        is_late = F.coalesce(place <= F.col("judged"), F.lit(False))
        runs = merge_runs(before.unionByName(signal_runs(met.filter(~is_late), limits, margin))).persist()
        try:
            tables.append_episodes(episodes(runs, open_too=False), path, batch_id)
            tables.append_alert_runs(last_runs(runs), path, batch_id)
        finally:
            runs.unpersist()
        write_all(met.filter(is_late).drop("judged"), batch_id, late_sinks)

    return start_batches(readings, judge, name, checkpoint, every, counted=counted)


def start_republish(
    messages: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    topics: str = "sensors/#",
    every: str | None = None,
    name: str = "republish",
    reject_sinks: list[Sink] = (),
) -> StreamingQuery:
    """Forward messages keyed by their topic, with the topic written into them.

    Messages that cannot carry it go to the reject sinks with their reason.
    """
    _check(messages.sparkSession, [*sinks, *reject_sinks])
    classified = classify_forwarding(filter_topics(messages, topics))

    def route(batch: DataFrame, batch_id: int) -> None:
        forwarded = batch.filter(F.col("reject_reason").isNull())
        write_all(keyed_records(forwarded), batch_id, sinks)
        refused = quality.rejected(batch).select(
            "payload", "ingest_time", "reject_reason", F.col("topic").alias("mqtt_topic")
        )
        write_all(refused, batch_id, reject_sinks)

    return start_batches(classified, route, name, checkpoint, every)


def _check(spark: SparkSession, sinks: list[Sink]) -> None:
    for sink in sinks:
        sink.check(spark)


def supervise(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until any query ends, stop the others, and raise what ended it."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
