"""

Sensor readings are derived from the ``events`` table (see ``FIXTURES.md``).
``native`` time spreads over 30 days, ``dense`` time packs the same events into
two hours, so that 5-minute groups have many rows.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import TimestampType

from fieldpulse.functions.topics import topic_level
from fieldpulse.operators import episodes, ingest, latest, quality, state, windows
from fieldpulse.plans import catalog, published, reports
from fieldpulse.schema import PLAUSIBLE_RANGES, READING_CONTRACT, READING_FIELDS, WINDOW_STATS_COLUMNS, ColumnRule
from fieldpulse.session import scratch_path, written
from fieldpulse.sources import batches, clustered, replay, tables
from fieldpulse.sources.events import (
    EVENTS_DDL,
    event_k,
    messages_from_events,
    read_events,
    readings_from_events,
)
from fieldpulse.sources.topic import MessageSource, file_source
from fieldpulse.streaming import app, backfill, jobs, reports as batch_reports, sinks

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_HOURLY = "2024-01-30 00:00:00"
AS_OF_RETENTION = "2024-02-10 00:00:00"
HALF_TIME = "2024-01-15 00:00:00"
LATE_BEFORE = "2024-01-08 00:00:00"
ARRIVALS_PER_BATCH = 1000
FILES_PER_STEP = 8
# Small row groups, so that the files of a big step are read by more tasks than there are files.
STEP_GROUP_BYTES = 4 * 1024 * 1024
CHAT_DDL = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
FILES_PER_BATCH = 256
ALERT_LIMITS = {
    "temperature": (10.0, 60.0),
    "humidity": (20.0, 70.0),
    "pressure": (960.0, 1050.0),
    "vibration": (0.0, 25.0),
}
# Tighter than the stored contract, so that some rows break it.
TIGHT_CONTRACT = {
    **READING_CONTRACT,
    "location": ColumnRule(11),
    "device_type": ColumnRule(10, required=True),
    "unit": ColumnRule(2, required=True),
}

_REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; its timestamps leave as UTC wall-clock values."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        result = build(spark, sf_dir)
        return result.select(*[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in result.schema
        ])

    _REGISTERED[build.__name__] = run
    return run


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- Inputs -----------------------------------------------------------------


def _readings(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """All readings with their event, good or not."""
    return readings_from_events(read_events(spark, sf_dir), dense, keep=["event_id"])


def _stored(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """The reading table: accepted readings only."""
    return quality.clean_readings(_readings(spark, sf_dir, dense))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(read_events(spark, sf_dir), dense=True, keep=["event_id"])


def _parsed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted readings that went through the JSON message."""
    classified = quality.classify_messages(
        _messages(spark, sf_dir), keep=["event_id", "ingest_time"]
    )
    return quality.accepted(classified)


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What devices sent: an unknown field, some with an outdated topic, and chat text."""
    readings = readings_from_events(
        read_events(spark, sf_dir), dense=True, keep=["event_id", "props"]
    )
    body = F.struct(
        *[name for name in READING_FIELDS if name != "mqtt_topic"],
        F.when(F.col("sensor_type") == "vibration", "sent/by/device").alias("mqtt_topic"),
        event_k().alias("k"),
    )
    from_devices = readings.select(
        F.lit("events").alias("origin"),
        F.col("event_id").alias("record_id"),
        F.col("mqtt_topic").alias("topic"),
        F.to_json(body, {"timestampFormat": ingest.JSON_TIMESTAMP}).cast("binary").alias("value"),
    )
    return from_devices.unionByName(_chat(spark, sf_dir))


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.select(
        F.lit("conversations").alias("origin"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("record_id"),
        F.lit("sensors/chat").alias("topic"),
        F.col("text").cast("binary").alias("value"),
    )


# --- Ingest -----------------------------------------------------------------


def _reading_table(spark: SparkSession, sf_dir: str) -> str:
    """The reading table written by day and sensor type; returns its path."""
    path = scratch_path(spark, "reading-table")
    tables.append_readings(_stored(spark, sf_dir).drop("event_id"), path, 0)
    return path


@query
def scan_readings(spark, sf_dir):
    """The stored reading table, partition columns turned back into rows."""
    stored = batches.read_batches(spark, _reading_table(spark, sf_dir), tables.READINGS_TABLE_DDL)
    return stored.drop("event_day")


@query
def topic_filter(spark, sf_dir):
    matching = ingest.filter_topics(_messages(spark, sf_dir), "sensors/temperature/#")
    return matching.select("event_id", "topic")


@query
def topic_filter_level(spark, sf_dir):
    matching = ingest.filter_topics(_messages(spark, sf_dir), "sensors/+/device-003")
    return matching.select("event_id", "topic")


@query
def parse_readings(spark, sf_dir):
    return ingest.parse_readings(_messages(spark, sf_dir), keep=["event_id"])


@query
def enrich_topic(spark, sf_dir):
    enriched = ingest.enrich_topic(_sent(spark, sf_dir))
    fields = F.from_json("value", "mqtt_topic STRING, device_id STRING, value DOUBLE, k INT")
    return enriched.select("record_id", F.inline(F.array(fields)))


@query
def topic_parts(spark, sf_dir):
    parsed = ingest.parse_readings(_messages(spark, sf_dir), keep=["event_id", "topic"])
    kind, device = topic_level(F.col("topic"), 1), topic_level(F.col("topic"), 2)
    return parsed.select(
        "event_id",
        kind.alias("topic_sensor"),
        device.alias("topic_device"),
        ((kind == F.col("sensor_type")) & (device == F.col("device_id"))).alias("agrees"),
    )


@query
def republish_records(spark, sf_dir):
    records = ingest.keyed_records(ingest.enrich_topic(_sent(spark, sf_dir)))
    read_back = F.from_json("value", "device_id STRING, value DOUBLE, timestamp TIMESTAMP, "
                            "quality STRING, mqtt_topic STRING, k INT")
    return records.select("key", F.inline(F.array(read_back)))


# --- Validation -------------------------------------------------------------


@query
def clean_readings(spark, sf_dir):
    return _parsed_clean(spark, sf_dir).drop("ingest_time")


@query
def clean_by_rules(spark, sf_dir):
    rules = quality.range_rules(spark)
    kept = quality.clean_by_rules(_readings(spark, sf_dir, dense=True), rules)
    return kept.drop("ingest_time")


@query
def reject_reasons(spark, sf_dir):
    classified = quality.classify_messages(_sent(spark, sf_dir), keep=["origin", "record_id"])
    return classified.select("origin", "record_id", "sensor_type", "value", "reject_reason")


@query
def constraint_violations(spark, sf_dir):
    refused = quality.violating(_readings(spark, sf_dir), TIGHT_CONTRACT)
    return refused.select("event_id", "device_id", "violations")


# --- Window statistics ------------------------------------------------------


@query
def window_stats_5m(spark, sf_dir):
    return windows.window_stats(_parsed_clean(spark, sf_dir))


@query
def window_stats_uncleaned(spark, sf_dir):
    """Statistics over readings of which every third has no value."""
    gaps = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return windows.window_stats(_readings(spark, sf_dir, dense=True).withColumn("value", gaps))


@query
def window_stats_rollup_1h(spark, sf_dir):
    moments = windows.window_moments(_stored(spark, sf_dir, dense=True))
    return windows.present_moments(windows.rollup_windows(moments, "1 hour"), digits=6)


@query
def window_stats_closed(spark, sf_dir):
    """The statistics stream run to its end, read from the table it wrote.

    The files of the table are in no order of time, so they are one micro-batch:
    in several, the watermark of the first would drop rows of the next as late.
    """
    base = scratch_path(spark, "window-stats")
    clean = quality.accepted(quality.classify_messages(
        _message_stream(spark, sf_dir), keep=["event_id", "ingest_time"]
    ))
    jobs.start_window_stats(
        clean, [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint",
        name="window_stats_closed",
    ).awaitTermination()
    return tables.read_window_stats(spark, f"{base}/table").select(*WINDOW_STATS_COLUMNS)


@query
def window_stats_backfilled(spark, sf_dir):
    """The same statistics from stored messages, staged in order of time and taken in four batches."""
    base = scratch_path(spark, "backfill")
    backfill.window_stats_backfill(
        spark, _messages(spark, sf_dir), base, steps=4, start=lambda stream: jobs.start_window_stats(
            stream, [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint", name="window_stats_backfilled",
        ),
    )
    return _with_sums(tables.read_window_stats(spark, f"{base}/table"))


@query
def latest_windows_top20(spark, sf_dir):
    return reports.latest_windows(windows.window_stats(_stored(spark, sf_dir, dense=True)))


@query
def key_sum_rollup(spark, sf_dir):
    """Rejected and uncertain readings per window, counted per batch, then added up."""
    counted = _readings(spark, sf_dir, dense=True).withColumn("batch", _arrival_batch())
    per_batch = counted.groupBy(
        "batch", F.window("timestamp", "5 minutes").alias("w"), "device_id", "sensor_type", "location"
    ).agg(
        F.count_if(F.col("quality") == "uncertain").alias("uncertain"),
        F.count_if(F.col("value") > 150).alias("above_150"),
    )
    rows = per_batch.select(
        "device_id", "sensor_type", F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"), "location", "uncertain", "above_150",
    )
    return windows.rollup_sum(rows, ["device_id", "sensor_type", "window_start"])


# --- Reports ----------------------------------------------------------------


@query
def hourly_temperature(spark, sf_dir):
    hourly = reports.hourly_temperature(_stored(spark, sf_dir), as_of=AS_OF_HOURLY)
    return _rounded(hourly, "avg_temp")


@query
def temperature_readings(spark, sf_dir):
    return reports.temperature_readings(_stored(spark, sf_dir))


@query
def device_sensor_stats(spark, sf_dir):
    return _rounded(reports.device_sensor_stats(_stored(spark, sf_dir)), "mean_val", "std_val")


@query
def anomalies(spark, sf_dir):
    found = reports.anomalies(_stored(spark, sf_dir, dense=True))
    return _rounded(found, "mean_val", "std_val", "z_score")


@query
def anomalies_windowed(spark, sf_dir):
    found = reports.anomalies_windowed(_stored(spark, sf_dir, dense=True))
    return _rounded(found, "mean_val", "std_val", "z_score")


@query
def anomalies_view(spark, sf_dir):
    """The anomalies as a catalog view shows them."""
    stored = _stored(spark, sf_dir, dense=True)
    catalog.register_views(stored, state.partial_states(stored, 0))
    return _rounded(spark.table("anomalies"), "mean_val", "std_val", "z_score")


@query
def sensor_type_summary(spark, sf_dir):
    return _rounded(reports.sensor_type_summary(_stored(spark, sf_dir)), "avg")


@query
def latest_readings_top20(spark, sf_dir):
    return reports.latest_readings(_stored(spark, sf_dir))


# --- Current state ----------------------------------------------------------


def _arrival_batch():
    """Events in order of arrival, a thousand to a batch."""
    return F.floor(F.col("event_id") / ARRIVALS_PER_BATCH)


@query
def device_state_partials(spark, sf_dir):
    partials = state.partial_states(_stored(spark, sf_dir, dense=True), _arrival_batch())
    return partials.select(
        "batch_id", "device_id", "sensor_type", "location",
        F.col("latest.value").alias("latest_value"),
        F.col("latest.timestamp").alias("latest_ts"),
        "max_value", "min_value", "total_readings",
    )


@query
def device_current(spark, sf_dir):
    partials = state.partial_states(_stored(spark, sf_dir, dense=True), _arrival_batch())
    return state.device_current(partials)


@query
def device_current_streamed(spark, sf_dir):
    """Messages streamed into the partial-state table, merged on reading."""
    path = scratch_path(spark, "states")
    _run_readings_stream(spark, sf_dir, sinks=[sinks.states_sink(path)])
    return tables.read_device_current(spark, path)


@query
def threshold_alerts(spark, sf_dir):
    partials = state.partial_states(_stored(spark, sf_dir, dense=True), _arrival_batch())
    return reports.threshold_alerts(state.device_current(partials), ALERT_LIMITS)


@query
def alert_episodes(spark, sf_dir):
    """Episodes of readings beyond the limits, over all stored readings."""
    return episodes.alert_episodes(_stored(spark, sf_dir, dense=True), ALERT_LIMITS)


@query
def alert_episodes_streamed(spark, sf_dir):
    """The same episodes kept by a stream over four batches in order of time."""
    base = scratch_path(spark, "alerts")
    rows = _stored(spark, sf_dir, dense=True).drop("event_id")
    backfill.stage_by_time(rows, base, steps=4)
    backfill.run_steps(spark, base, rows.schema, lambda stream: jobs.start_alerts(
        stream, f"{base}/alerts", ALERT_LIMITS, f"{base}/checkpoint",
    ))
    return tables.read_episodes(spark, f"{base}/alerts")


# --- Tables -----------------------------------------------------------------


@query
def latest_version_readings(spark, sf_dir):
    stored = _stored(spark, sf_dir, dense=True)
    return latest.latest_version(stored, version=["ingest_time", "event_id"], whole_seconds=True)


@query
def readings_streamed(spark, sf_dir):
    """Messages streamed into the reading table, latest versions read back."""
    path = scratch_path(spark, "readings")
    _run_readings_stream(spark, sf_dir, sinks=[sinks.readings_sink(path)])
    return tables.read_readings(spark, path, whole_seconds=True)


@query
def readings_settled(spark, sf_dir):
    """The streamed reading table after its batches were merged into their partitions."""
    path = scratch_path(spark, "readings")
    _run_readings_stream(spark, sf_dir, sinks=[sinks.readings_sink(path)])
    tables.settle_readings(spark, path, upto=batches.fresh_batches(spark, path)[-1])
    return tables.read_readings(spark, path)


@query
def clustered_readings(spark, sf_dir):
    """One sensor type from files written in ranges of type and day."""
    path = scratch_path(spark, "clustered")
    tables.write_clustered(_stored(spark, sf_dir), path)
    return reports.of_type(spark.read.parquet(path), "temperature").select(
        "device_id", "sensor_type", "value", "timestamp"
    )


@query
def readings_settled_filtered(spark, sf_dir):
    """A table settled after every batch by its key filters; the first batch comes once more at the end."""
    base = scratch_path(spark, "filtered")
    steps = _dense_halves(read_events(spark, sf_dir))
    again = steps.filter("step = 0").withColumn("step", F.lit(3))
    steps = steps.unionByName(again)
    for number in range(4):
        _write_step(steps, number, base)
        messages = messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])
        jobs.start_readings(
            messages, [sinks.readings_sink(f"{base}/readings")], f"{base}/checkpoint", keep=["ingest_time"],
        ).awaitTermination()
        tables.settle_readings(spark, f"{base}/readings", upto=number)
    return tables.read_readings(spark, f"{base}/readings")


@query
def ingest_time_stamped(spark, sf_dir):
    """Messages without an ingest time get their batch's: rows of every batch, and whether they share one time."""
    base = scratch_path(spark, "stamped")
    jobs.start_readings(
        _message_steps(spark, sf_dir, base).drop("ingest_time"), [sinks.readings_sink(f"{base}/readings")],
        f"{base}/checkpoint",
    ).awaitTermination()
    stored = spark.read.parquet(f"{base}/readings/fresh")
    since = F.lit("2024-12-31").cast("timestamp")
    return stored.groupBy(F.col("batch_id").cast("int").alias("batch")).agg(
        F.count("*").alias("rows"),
        ((F.count_distinct("ingest_time") == 1) & (F.min("ingest_time") > since)).alias("one_time"),
    )


@query
def readings_triggered(spark, sf_dir):
    """The reading table of a stream that runs by an interval until it has taken what there is."""
    base = scratch_path(spark, "triggered")
    running = jobs.start_readings(
        _message_stream(spark, sf_dir, FILES_PER_BATCH), [sinks.readings_sink(f"{base}/readings")],
        f"{base}/checkpoint", keep=["ingest_time"], every="1 second",
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return tables.read_readings(spark, f"{base}/readings")


@query
def empty_batches_skipped(spark, sf_dir):
    """Rows of every batch folder; the second batch has no good reading and leaves none in the reading table."""
    base = scratch_path(spark, "skipped")
    events = read_events(spark, sf_dir)
    early, good = F.col("ts") < F.lit(HALF_TIME).cast("timestamp"), event_k() >= 5
    steps = events.withColumn("step", F.when(early, 0).when(~good, 1).otherwise(2))
    for number in range(3):
        _write_step(steps, number, base)
    messages = messages_from_events(_step_source(base).stream(spark), dense=True)
    jobs.start_readings(
        messages, [sinks.readings_sink(f"{base}/readings")], f"{base}/checkpoint", keep=["ingest_time"],
        reject_sinks=[sinks.rejects_sink(f"{base}/rejects")], counted=False,
    ).awaitTermination()
    counted = [
        spark.read.parquet(f"{base}/{name}/fresh").groupBy(F.col("batch_id").cast("int").alias("batch"))
        .agg(F.count("*").alias("rows")).select(F.lit(name).alias("stored"), "batch", "rows")
        for name in ("readings", "rejects")
    ]
    return counted[0].union(counted[1])


@query
def reclustered_readings(spark, sf_dir):
    """Readings appended in four overlapping parts, then reclustered: rows of one type, and files over one point."""
    path = scratch_path(spark, "reclustered")
    rows = _stored(spark, sf_dir)
    for part in range(4):
        clustered.append_clustered(rows.filter(F.col("event_id") % 4 == part), path)
    before = clustered.overlaps(clustered.files(spark, path)).agg(F.max("depth")).first()[0]
    clustered.recluster(spark, path, rows.schema, depth=1)
    after = clustered.overlaps(clustered.files(spark, path)).agg(F.max("depth")).first()[0]
    clustered.vacuum_clustered(spark, path)
    found = reports.of_type(clustered.read_clustered(spark, path, rows.schema), "temperature")
    return found.select(
        "device_id", "sensor_type", "value", "timestamp",
        F.lit(before >= 4).alias("was_deep"), F.lit(after <= 1).alias("is_flat"),
    )


@query
def sorted_partitions(spark, sf_dir):
    """Whether every partition of the reading table is in order of device and time, file by file."""
    path = _reading_table(spark, sf_dir)
    placed = batches.read_batches(spark, path, tables.READINGS_TABLE_DDL).select(
        "event_day", "sensor_type", F.struct("device_id", "timestamp").alias("place"),
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"),
    )
    before = F.lag("place").over(Window.partitionBy("event_day", "sensor_type", "file").orderBy("row"))
    return placed.withColumn("in_order", before.isNull() | (before <= F.col("place"))).groupBy(
        "event_day", "sensor_type"
    ).agg(F.bool_and("in_order").alias("in_order"))


@query
def ingest_time_filled(spark, sf_dir):
    """Readings that came without an ingest time: they get the batch's, one for all of them."""
    path = scratch_path(spark, "filled")
    missing = F.when(F.col("event_id") % 2 == 0, F.col("ingest_time"))
    rows = _stored(spark, sf_dir).withColumn("ingest_time", missing).drop("event_id")
    tables.append_readings(rows, path, 0)
    stored = batches.read_batches(spark, path, tables.READINGS_TABLE_DDL)
    filled = F.col("ingest_time") > F.lit("2024-12-31").cast("timestamp")
    return stored.groupBy(filled.alias("filled")).agg(
        F.count("*").alias("rows"),
        F.when(filled, F.count_distinct("ingest_time")).alias("times"),
    )


@query
def readings_restarted(spark, sf_dir):
    """The reading table of a stream that ended, found more files, and went on from its checkpoint."""
    base = scratch_path(spark, "restarted")
    steps = _dense_halves(read_events(spark, sf_dir))
    for number in range(3):
        _write_step(steps, number, base)
        messages = messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])
        jobs.start_readings(
            messages, [sinks.readings_sink(f"{base}/readings")], f"{base}/checkpoint", keep=["ingest_time"],
        ).awaitTermination()
    return tables.read_readings(spark, f"{base}/readings")


@query
def sinks_streamed(spark, sf_dir):
    """Rows that each of several sinks of one stream got."""
    base = scratch_path(spark, "sinks")
    external = sinks.format_sink("external", "parquet", {"path": f"{base}/external"})
    _run_readings_stream(
        spark, sf_dir,
        sinks=[sinks.readings_sink(f"{base}/readings"), sinks.states_sink(f"{base}/states"), external],
        reject_sinks=[sinks.rejects_sink(f"{base}/rejects")],
    )
    current = tables.read_device_current(spark, f"{base}/states")
    total = F.count("*").alias("rows")
    named = lambda name, rows: rows.select(F.lit(name).alias("sink"), "rows")
    stored = batches.read_batches(spark, f"{base}/readings", tables.READINGS_TABLE_DDL)
    return (
        named("readings", stored.agg(total))
        .union(named("states", current.agg(F.sum("total_readings").alias("rows"))))
        .union(named("external", spark.read.parquet(f"{base}/external").agg(total)))
        .union(named("rejects", tables.read_rejects(spark, f"{base}/rejects").agg(total)))
    )


#: Rules that replace the plausible ranges in two steps, each wider.
WIDER = {**PLAUSIBLE_RANGES, "vibration": (0.0, 120.0), "co2": (0.0, 100.0)}
WIDEST = {**WIDER, "humidity": (0.0, 1000.0), "pressure": (0.0, 5000.0), "co2": (0.0, 5000.0)}


@query
def rejects_replayed(spark, sf_dir):
    """Messages refused by the stream and replayed twice by changed rules, the third batch refused in between."""
    base = scratch_path(spark, "replayed")
    rejects, replays = f"{base}/rejects", f"{base}/replays"
    steps = _dense_halves(read_events(spark, sf_dir))
    for number in range(3):
        _write_step(steps, number, base)
        messages = messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])
        jobs.start_readings(
            messages, [sinks.readings_sink(f"{base}/readings")], f"{base}/checkpoint", keep=["ingest_time"],
            reject_sinks=[sinks.rejects_sink(rejects)],
        ).awaitTermination()
        if number:
            tables.settle_rejects(spark, rejects)
            replay.replay_rejects(spark, rejects, replays, WIDER if number == 1 else WIDEST)
    columns = ["device_id", "sensor_type", "value", "timestamp"]
    accepted = replay.read_with_replays(spark, f"{base}/readings", replays)
    refused = replay.pending(spark, rejects, replays)
    return accepted.select(*columns, F.lit(None).cast("string").alias("reject_reason"), F.lit(0).alias("attempt"))\
        .unionByName(refused.select(*columns, "reject_reason", "attempt"))


@query
def rejects_streamed(spark, sf_dir):
    """Messages the stream refused, with their reason and payload."""
    path = scratch_path(spark, "rejects")
    _run_readings_stream(spark, sf_dir, sinks=[], reject_sinks=[sinks.rejects_sink(path)])
    return tables.read_rejects(spark, path).drop("payload", "ingest_time")


@query
def daily_partitions(spark, sf_dir):
    stored = batches.read_batches(spark, _reading_table(spark, sf_dir), tables.READINGS_TABLE_DDL)
    return reports.readings_per_partition(stored)


@query
def retention_30d(spark, sf_dir):
    """The reading table after its expired days were dropped, the boundary day cut by row."""
    path = _reading_table(spark, sf_dir)
    as_of = datetime.fromisoformat(AS_OF_RETENTION).replace(tzinfo=timezone.utc)
    tables.expire_readings(spark, path, as_of)
    return tables.read_retained(spark, path, as_of).drop("ingest_time", "event_day")


@query
def catalog_views(spark, sf_dir):
    """What persistent views show of a job's tables, after one batch, and after a second one and a vacuum."""
    root = scratch_path(spark, "published")
    database = f"published_{uuid.uuid4().hex}"
    rows = _stored(spark, sf_dir).drop("event_id")
    half = F.col("timestamp") < F.lit(HALF_TIME).cast("timestamp")
    published.create(spark, root, database, AS_OF_HOURLY)
    shown = []
    for number, part in enumerate([rows.filter(half), rows.filter(~half)]):
        tables.append_readings(part, f"{root}/readings", number)
        tables.append_states(part, f"{root}/states", number)
        tables.settle_readings(spark, f"{root}/readings", upto=number)
        tables.settle_states(spark, f"{root}/states", upto=number)
        published.publish(spark, root, database)
        tables.vacuum_readings(spark, f"{root}/readings")
        batches.vacuum(spark, f"{root}/states", cumulative=True)
        views = {
            "readings": F.count("*"), "hourly_temperature": F.sum("readings"), "anomalies": F.count("*"),
            "device_current": F.sum("total_readings"),
        }
        for name, amount in views.items():
            seen = spark.table(f"{database}.{name}").agg(F.count("*").alias("rows"), amount.alias("readings"))
            shown.append((number, name, *seen.first()))
    return spark.createDataFrame(shown, "batch INT, view STRING, rows BIGINT, readings BIGINT")


# --- Streams ----------------------------------------------------------------


def _message_stream(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    # As a pattern the path may name one file as well as a folder of files.
    source = file_source(f"{sf_dir}/events.parque[t]", "parquet", EVENTS_DDL, files)
    events = source.stream(spark)
    return messages_from_events(events, dense=True, keep=["event_id"])


def _run_readings_stream(spark: SparkSession, sf_dir: str, **outputs) -> None:
    """Run the readings stream over all events to its end."""
    jobs.start_readings(
        _message_stream(spark, sf_dir, FILES_PER_BATCH),
        checkpoint=scratch_path(spark, "checkpoint"),
        keep=["ingest_time"],
        **outputs,
    ).awaitTermination()


def _chat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = file_source(f"{sf_dir}/conversations.parque[t]", "parquet", CHAT_DDL, FILES_PER_BATCH)
    return source.stream(spark).select(
        F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.lit("sensors/chat").alias("topic"), F.current_timestamp().alias("ingest_time"),
    )


def _run_republish(spark: SparkSession, sf_dir: str) -> str:
    """Forward sensor messages and chat into files; returns the folder of both outputs."""
    base = scratch_path(spark, "republish")
    messages = _message_stream(spark, sf_dir, FILES_PER_BATCH).drop("event_id")
    jobs.start_republish(
        messages.unionByName(_chat_stream(spark, sf_dir)),
        [sinks.format_sink("forwarded", "parquet", {"path": f"{base}/forwarded"})],
        f"{base}/checkpoint",
        reject_sinks=[sinks.rejects_sink(f"{base}/rejects")],
    ).awaitTermination()
    return base


@query
def republish_streamed(spark, sf_dir):
    """Messages forwarded by the stream, read back."""
    forwarded = spark.read.parquet(f"{_run_republish(spark, sf_dir)}/forwarded")
    fields = F.from_json("value", "device_id STRING, value DOUBLE, mqtt_topic STRING")
    return forwarded.select("key", F.inline(F.array(fields)))


@query
def republish_rejects_streamed(spark, sf_dir):
    """Messages the forwarding stream could not write the topic into."""
    found = tables.read_rejects(spark, f"{_run_republish(spark, sf_dir)}/rejects")
    return found.select("mqtt_topic", "payload", "reject_reason")


@query
def first_deliveries_streamed(spark, sf_dir):
    """Readings of a stream that brings each message twice, kept once."""
    base = scratch_path(spark, "deliveries")
    twice = _message_stream(spark, sf_dir, FILES_PER_BATCH).union(_message_stream(spark, sf_dir, FILES_PER_BATCH))
    clean = quality.accepted(quality.classify_messages(twice, keep=["ingest_time"]))
    jobs.start_batches(
        latest.drop_redelivered(clean, "60 days"),
        sinks.readings_sink(f"{base}/readings").write, "first_deliveries", f"{base}/checkpoint",
    ).awaitTermination()
    stored = batches.read_batches(spark, f"{base}/readings", tables.READINGS_TABLE_DDL)
    return stored.select("device_id", "sensor_type", "timestamp")


@query
def late_rows_streamed(spark, sf_dir):
    """Window statistics of a stream whose third batch comes after its windows have closed."""
    base = scratch_path(spark, "late")
    events = _dense_halves(read_events(spark, sf_dir))
    for number in range(3):
        _write_step(events, number, base)
    messages = messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])
    clean = quality.accepted(quality.classify_messages(messages, keep=["ingest_time"]))
    jobs.start_window_stats(
        clean, [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint", name="late_rows",
    ).awaitTermination()
    return _with_sums(tables.read_window_stats(spark, f"{base}/table"))


def _with_sums(stored: DataFrame) -> DataFrame:
    """Sums, which have few decimals: the rows' order is not fixed, and a mean that ends in a 5 rounds either way."""
    presented = windows.present_moments(stored.drop("avg_value", "stddev_value", "event_day"), 6, keep_moments=True)
    total = F.round(F.col("mean") * F.col("value_count"), 4).alias("sum_value")
    return presented.select("*", total).drop("avg_value", "mean", "m2", "value_count")


def _run_corrected(spark: SparkSession, sf_dir: str) -> str:
    """Run the same stream with its late rows routed; returns the folder of both tables."""
    base = scratch_path(spark, "corrected")
    jobs.start_window_stats(
        _clean_steps(spark, sf_dir, base), [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint",
        correct=True, late_sinks=[sinks.late_sink(f"{base}/late")],
    ).awaitTermination()
    return base


@query
def late_readings_routed(spark, sf_dir):
    """The readings the statistics stream dropped as late."""
    found = tables.read_late(spark, f"{_run_corrected(spark, sf_dir)}/late")
    return found.drop("watermark", "event_day")


@query
def late_rows_corrected(spark, sf_dir):
    """The statistics with the late rows merged into the windows they missed, before and after settling."""
    base = _run_corrected(spark, sf_dir)
    loose = _with_sums(tables.read_window_stats(spark, f"{base}/table"))
    kept = written(loose.withColumn("settled", F.lit(False)), "corrected")
    for batch in batches.fresh_batches(spark, f"{base}/table"):
        tables.settle_window_stats(spark, f"{base}/table", upto=batch)
    settled = _with_sums(tables.read_window_stats(spark, f"{base}/table"))
    return kept.unionByName(settled.withColumn("settled", F.lit(True)))


@query
def anomalies_streamed(spark, sf_dir):
    """Anomalies of a stream in three batches, each judged by the statistics up to it."""
    base = scratch_path(spark, "anomalies")
    jobs.start_anomalies(
        _clean_steps(spark, sf_dir, base), f"{base}/moments", [sinks.anomalies_sink(f"{base}/anomalies")],
        f"{base}/checkpoint",
    ).awaitTermination()
    return _rounded(tables.read_anomalies(spark, f"{base}/anomalies"), "mean_val", "std_val", "z_score")


@query
def device_current_updated(spark, sf_dir):
    """Current states kept by a stream in update mode, restarted twice, beside what its state store holds."""
    base = scratch_path(spark, "current")
    steps = _dense_halves(read_events(spark, sf_dir))
    for number in range(3):
        _write_step(steps, number, base)
        messages = messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])
        clean = quality.accepted(quality.classify_messages(messages, keep=["ingest_time"]))
        jobs.start_current(clean, [sinks.current_sink(f"{base}/current")], f"{base}/checkpoint").awaitTermination()
    return jobs.current_beside_state(spark, f"{base}/checkpoint", f"{base}/current")


@query
def batch_reports_streamed(spark, sf_dir):
    """What a listener reported of the statistics stream's three batches."""
    base = scratch_path(spark, "reports")
    listener = batch_reports.BatchReports(spark, f"{base}/reports").attach()
    try:
        running = jobs.start_window_stats(
            _clean_steps(spark, sf_dir, base), [sinks.window_stats_sink(f"{base}/table")], f"{base}/checkpoint",
            counted=False,
        )
        running.awaitTermination()
        if not listener.wait_for(running):
            raise TimeoutError("the batches' reports did not come")
    finally:
        listener.detach()
    batch_reports.gather(spark, f"{base}/reports")
    found = batch_reports.read_reports(spark, f"{base}/reports")
    return found.select("batch_id", "input_rows", "watermark", "state_rows", F.col("late_groups") > 0)\
        .toDF("batch_id", "input_rows", "watermark", "state_rows", "late")


def _clean_steps(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Accepted readings of the events in three batches, streamed."""
    return quality.accepted(quality.classify_messages(_message_steps(spark, sf_dir, base), keep=["ingest_time"]))


def _message_steps(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Messages of the events in three batches, streamed."""
    events = _dense_halves(read_events(spark, sf_dir))
    for number in range(3):
        _write_step(events, number, base)
    return messages_from_events(_step_source(base).stream(spark), dense=True, keep=["event_id"])


def _write_step(events: DataFrame, number: int, base: str) -> None:
    """One step as a batch of its own: as many files as a trigger takes."""
    step = events.filter(F.col("step") == number).drop("step")
    step.repartition(FILES_PER_STEP).write.option("parquet.block.size", STEP_GROUP_BYTES).parquet(f"{base}/steps/{number}")


def _step_source(base: str) -> MessageSource:
    return file_source(f"{base}/steps/*", "parquet", EVENTS_DDL, FILES_PER_STEP)


def _dense_halves(events: DataFrame) -> DataFrame:
    """Events with their ``step``: the first half of the time, the second, late ones of the first week.

    Rows are late against the watermark of the batch before, which the first half sets.
    """
    early = F.col("ts") < F.lit(HALF_TIME).cast("timestamp")
    late = (F.col("ts") < F.lit(LATE_BEFORE).cast("timestamp")) & (F.col("event_id") % 10 == 0)
    return events.withColumn("step", F.when(late, 2).when(early, 0).otherwise(1))


@dataclass(frozen=True)
class _EventMessages(MessageSource):
    """Events as the topic records a job reads."""

    def stream(self, spark: SparkSession) -> DataFrame:
        return messages_from_events(super().stream(spark), dense=True)


@query
def job_streamed(spark, sf_dir):
    """Rows of every table after the whole job's queries ran over what there is."""
    base = scratch_path(spark, "job")
    files = file_source(f"{sf_dir}/events.parque[t]", "parquet", EVENTS_DDL, FILES_PER_BATCH)
    settings = app.Settings(
        _EventMessages(files.format, files.options, files.schema), f"{base}/tables", f"{base}/checkpoints",
        readings_every=None, stats_every=None,
    )
    for running in app.start(spark, settings):
        running.awaitTermination()
    stored = {
        "readings": batches.read_batches(spark, f"{base}/tables/readings", tables.READINGS_TABLE_DDL),
        "rejects": tables.read_rejects(spark, f"{base}/tables/rejects"),
        "window_stats": tables.read_window_stats(spark, f"{base}/tables/window_stats"),
        "device_current": tables.read_device_current(spark, f"{base}/tables/states"),
    }
    counted = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stored"), "rows") for name, rows in stored.items()
    ]
    return reduce(DataFrame.union, counted)


# --- Contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Five-minute statistics of parsed and validated sensor messages."""
    return window_stats_5m(spark, "/root/testdata/sf0.001")


def _optional(module: str):
    """The module, or None where it or its package has been taken away."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as missing:
        if missing.name in ("fieldpulse.llm", "corpus_pipeline"):
            return None
        raise


def queries() -> dict[str, Query]:
    found = dict(_REGISTERED)
    if corpus := _optional("fieldpulse.llm.queries"):
        found.update(corpus.QUERIES)
    if pipeline := _optional("corpus_pipeline"):
        found["pipeline"] = pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    from oracles import ORACLES

    found = dict(ORACLES)
    if corpus := _optional("fieldpulse.llm.queries"):
        found.update(corpus.ORACLES)
    if (pipeline := _optional("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found
