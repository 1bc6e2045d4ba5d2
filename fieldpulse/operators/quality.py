"""Accepting and rejecting readings; rows are routed, never silently lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldpulse.functions.checks import (
    breaks_contract,
    contract_violations,
    in_plausible_range,
    reject_reason,
)
from fieldpulse.operators.groups import table_bytes
from fieldpulse.operators.ingest import is_malformed, parse_readings
from fieldpulse.schema import GOOD_QUALITY, PLAUSIBLE_RANGES, READING_CONTRACT, ColumnRule

# Range tables up to this many bytes are broadcast; the size is measured first.
BROADCAST_RULE_BYTES = 16 * 1024 * 1024


def classify_messages(
    messages: DataFrame,
    payload: str = "value",
    keep: list[str] = (),
    ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES,
    clock_allowance: str | None = None,
) -> DataFrame:
    """Parsed messages with ``payload``, ``ingest_time`` and ``reject_reason``.

    The reason is NULL for accepted readings.  ``ingest_time`` is the current
    time, one value per batch or micro-batch, unless it is among the message
    columns to ``keep``.
    """
    text = messages.select(*keep, F.col(payload).cast("string").alias("payload"))
    parsed = parse_readings(text, "payload", keep=[*keep, "payload"])
    if "ingest_time" not in keep:
        parsed = parsed.withColumn("ingest_time", F.current_timestamp())
    return parsed.withColumn(
        "reject_reason", reject_reason(is_malformed("payload"), ranges, clock_allowance)
    )


def accepted(classified: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Rows without a reject reason, as plain readings."""
    unneeded = ["reject_reason", *([] if keep_payload else ["payload"])]
    return classified.filter(F.col("reject_reason").isNull()).drop(*unneeded)


def rejected(classified: DataFrame) -> DataFrame:
    """Rows with a reject reason, payload included so that they can be replayed."""
    return classified.filter(F.col("reject_reason").isNotNull())


def with_reject_reason(
    readings: DataFrame,
    ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES,
    clock_allowance: str | None = None,
) -> DataFrame:
    """Readings that are already parsed, with the reason for refusing them."""
    return readings.withColumn(
        "reject_reason", reject_reason(ranges=ranges, clock_allowance=clock_allowance)
    )


def clean_readings(
    readings: DataFrame, ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES
) -> DataFrame:
    """Good readings with a plausible value."""
    return readings.filter(
        (F.col("quality") == GOOD_QUALITY) & F.col("value").isNotNull() & in_plausible_range(ranges)
    )


def clean_by_rules(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Like :func:`clean_readings` with the ranges in a table.

    ``rules`` has ``sensor_type, low, high``; a reading stays if any rule of its
    type covers its value.  The table is broadcast after measuring it.  A bigger
    one is left to the planner: the adaptive skew join splits a common type.
    """
    small = table_bytes(rules) <= BROADCAST_RULE_BYTES
    side = F.broadcast(rules) if small else rules
    good = readings.filter((F.col("quality") == GOOD_QUALITY) & F.col("value").isNotNull())
    r, s = good.alias("r"), side.alias("s")
    covered = (F.col("r.sensor_type") == F.col("s.sensor_type")) & F.col("r.value").between(
        F.col("s.low"), F.col("s.high")
    )
    return r.join(s, covered, "left_semi")


def range_rules(spark, ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES) -> DataFrame:
    """The plausible ranges as a table for :func:`clean_by_rules`."""
    rows = [(kind, float(low), float(high)) for kind, (low, high) in ranges.items()]
    return spark.createDataFrame(rows, "sensor_type STRING, low DOUBLE, high DOUBLE")


def conforming(
    readings: DataFrame, contract: dict[str, ColumnRule] = READING_CONTRACT
) -> DataFrame:
    """Readings that a table with these constraints takes."""
    return readings.filter(~breaks_contract(contract))


def violating(
    readings: DataFrame, contract: dict[str, ColumnRule] = READING_CONTRACT
) -> DataFrame:
    """Readings such a table refuses, with the ``violations`` they have."""
    return readings.filter(breaks_contract(contract)).withColumn(
        "violations", contract_violations(contract)
    )
