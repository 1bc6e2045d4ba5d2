"""The whole job: messages into readings, states, rejects and window statistics.

    spark-submit -m fieldpulse.streaming.app   (settings from the environment)
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.operators.quality import accepted, classify_messages
from fieldpulse.schema import WINDOW_STATS_COLUMNS
from fieldpulse.session import build_session, configured_folder
from fieldpulse.sources.topic import MessageSource, kafka_source
from fieldpulse.streaming import jobs, reports, sinks


@dataclass(frozen=True)
class Settings:
    """Where messages come from, where results go, and how often."""

    source: MessageSource
    tables: str
    checkpoints: str | None = None
    readings_every: str | None = "10 seconds"
    stats_every: str | None = "30 seconds"
    watermark: str = jobs.WATERMARK
    clock_allowance: str | None = None
    first_deliveries_only: bool = False
    extra_reading_sinks: list[sinks.Sink] = field(default_factory=list)
    extra_stats_sinks: list[sinks.Sink] = field(default_factory=list)
    extra_reject_sinks: list[sinks.Sink] = field(default_factory=list)
    republish_from: MessageSource | None = None
    republish_sinks: list[sinks.Sink] = field(default_factory=list)
    republish_topics: str = "sensors/#"
    correct_late_rows: bool = False
    judge_anomalies: bool = False
    alert_limits: dict[str, tuple[float, float]] = field(default_factory=dict)
    batch_reports: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        """Settings from environment variables; see README.md for all of them."""
        servers = env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
        bound = env.get("MAX_RECORDS_PER_BATCH", "5000000")
        reading = {
            "start": env.get("STARTING_OFFSETS", "latest"),
            "fail_on_data_loss": _flag(env, "FAIL_ON_DATA_LOSS", True),
            "max_records_per_batch": int(bound) if bound != "none" else None,
        }
        republish_from = env.get("REPUBLISH_FROM")
        return cls(
            source=kafka_source(servers, env.get("KAFKA_TOPIC", "sensor-readings"), **reading),
            tables=env["TABLES_PATH"],
            checkpoints=env.get("CHECKPOINTS_PATH"),
            readings_every=_interval(env, "READINGS_EVERY", "10 seconds"),
            stats_every=_interval(env, "STATS_EVERY", "30 seconds"),
            watermark=env.get("WATERMARK", jobs.WATERMARK),
            clock_allowance=env.get("CLOCK_ALLOWANCE"),
            first_deliveries_only=_flag(env, "FIRST_DELIVERIES_ONLY", False),
            extra_reading_sinks=_jdbc(env, "sensor_readings") + _warehouse(env, "WAREHOUSE_OPTIONS"),
            extra_stats_sinks=_jdbc(env, "sensor_aggregations") + _warehouse(env, "WAREHOUSE_STATS_OPTIONS"),
            extra_reject_sinks=_dead_letters(servers, env.get("DEAD_LETTER_TOPIC")),
            republish_from=kafka_source(servers, republish_from, **reading) if republish_from else None,
            republish_sinks=[sinks.topic_sink("republish", servers, env["REPUBLISH_TO"])] if republish_from else [],
            republish_topics=env.get("REPUBLISH_TOPICS", "sensors/#"),
            correct_late_rows=_flag(env, "CORRECT_LATE_ROWS", False),
            judge_anomalies=_flag(env, "JUDGE_ANOMALIES", False),
            alert_limits={kind: (low, high) for kind, (low, high) in json.loads(env.get("ALERT_LIMITS", "{}")).items()},
            batch_reports=_flag(env, "BATCH_REPORTS", True),
        )


def _flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    value = env.get(name, str(default)).lower()
    if value not in ("true", "false"):
        raise ValueError(f"{name} is true or false, not {value!r}")
    return value == "true"


def _interval(env: Mapping[str, str], name: str, default: str) -> str | None:
    """A trigger interval; ``once`` takes what is there and ends."""
    value = env.get(name, default)
    return None if value == "once" else value


def _jdbc(env: Mapping[str, str], table: str) -> list[sinks.Sink]:
    """A database sink if ``JDBC_URL`` is set."""
    if not env.get("JDBC_URL"):
        return []
    return [sinks.jdbc_sink(
        f"jdbc:{table}",
        url=env["JDBC_URL"],
        table=table,
        user=env.get("JDBC_USER", ""),
        password=env.get("JDBC_PASSWORD", ""),
        driver=env["JDBC_DRIVER"],
        connections=int(env.get("JDBC_CONNECTIONS", "8")),
    )]


def _warehouse(env: Mapping[str, str], options: str) -> list[sinks.Sink]:
    """A sink of the data source ``WAREHOUSE_FORMAT`` with JSON options, if both are set."""
    if not (env.get("WAREHOUSE_FORMAT") and env.get(options)):
        return []
    return [sinks.format_sink("warehouse", env["WAREHOUSE_FORMAT"], json.loads(env[options]))]


def _dead_letters(servers: str, topic: str | None) -> list[sinks.Sink]:
    """A topic for refused messages: the payload, keyed by the reason."""
    if not topic:
        return []
    target = sinks.topic_sink("dead_letters", servers, topic)
    return [sinks.dead_letter_sink(target)]


def start(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    """Start the queries; each reads the source on its own and has its own checkpoint.

    Readings without a device or a time pass validation.  The extra sinks are
    strict tables, so they get the conforming rows and the rest is kept aside;
    those for statistics get the declared columns only.  With batch reports no
    query counts its batches.
    """
    checkpoints = settings.checkpoints or f"{configured_folder(spark)}/fieldpulse-streams"
    tables = settings.tables
    strict = [
        sinks.checked_sink(sink, sinks.rejects_sink(f"{tables}/refused_by_{n}"))
        for n, sink in enumerate(settings.extra_reading_sinks)
    ]
    declared = [sinks.columns_sink(sink, WINDOW_STATS_COLUMNS) for sink in settings.extra_stats_sinks]
    queries = [jobs.start_readings(
        settings.source.stream(spark),
        [
            sinks.readings_sink(f"{tables}/readings"),
            sinks.states_sink(f"{tables}/states"),
            *strict,
        ],
        f"{checkpoints}/readings",
        reject_sinks=[sinks.rejects_sink(f"{tables}/rejects"), *settings.extra_reject_sinks],
        every=settings.readings_every,
        clock_allowance=settings.clock_allowance,
        counted=not settings.batch_reports,
    )]
    clean = accepted(classify_messages(
        settings.source.stream(spark), clock_allowance=settings.clock_allowance
    ))
    queries.append(jobs.start_window_stats(
        clean,
        [sinks.window_stats_sink(f"{tables}/window_stats"), *declared],
        f"{checkpoints}/window_stats",
        every=settings.stats_every,
        watermark=settings.watermark,
        first_deliveries_only=settings.first_deliveries_only,
        correct=settings.correct_late_rows,
        late_sinks=[sinks.late_sink(f"{tables}/late")] if settings.correct_late_rows else [],
        counted=not settings.batch_reports,
    ))
    if settings.judge_anomalies:
        queries.append(jobs.start_anomalies(
            clean, f"{tables}/group_moments", [sinks.anomalies_sink(f"{tables}/anomalies")],
            f"{checkpoints}/anomalies", every=settings.readings_every, counted=not settings.batch_reports,
        ))
    if settings.alert_limits:
        queries.append(jobs.start_alerts(
            clean, f"{tables}/alerts", settings.alert_limits, f"{checkpoints}/alerts",
            late_sinks=[sinks.late_sink(f"{tables}/late_for_alerts")],
            every=settings.readings_every, counted=not settings.batch_reports,
        ))
    if settings.republish_from:
        queries.append(jobs.start_republish(
            settings.republish_from.stream(spark),
            settings.republish_sinks,
            f"{checkpoints}/republish",
            topics=settings.republish_topics,
            every=settings.readings_every,
            reject_sinks=[
                sinks.rejects_sink(f"{tables}/refused_by_republish"), *settings.extra_reject_sinks
            ],
        ))
    return queries


def main() -> None:
    spark = build_session("fieldpulse")
    settings = Settings.from_env()
    if settings.batch_reports:
        reports.BatchReports(spark, f"{settings.tables}/reports").attach()
    jobs.supervise(spark, start(spark, settings))


if __name__ == "__main__":
    main()
