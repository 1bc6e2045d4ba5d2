"""Row checks as column expressions: plausibility, reject reasons, constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from fieldpulse.schema import GOOD_QUALITY, PLAUSIBLE_RANGES, READING_CONTRACT, ColumnRule


def in_plausible_range(ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES) -> Column:
    """True when the value lies in the range of its sensor type.

    A type without a range, a NULL and NaN give false or NULL, never true.
    """
    per_type = [
        (F.col("sensor_type") == kind) & F.col("value").between(low, high)
        for kind, (low, high) in ranges.items()
    ]
    return reduce(Column.__or__, per_type, F.lit(False))


def reject_reason(
    malformed: Column | None = None,
    ranges: dict[str, tuple[float, float]] = PLAUSIBLE_RANGES,
    clock_allowance: str | None = None,
) -> Column:
    """First reason for refusing a reading, NULL for an accepted one.

    ``clock_allowance`` (an interval such as ``"10 minutes"``) also refuses
    readings stamped later than ingest time plus the allowance; one such device
    would otherwise push the watermark forward for all.
    """
    known_type = F.coalesce(F.col("sensor_type").isin(*ranges), F.lit(False))
    plausible = F.coalesce(in_plausible_range(ranges), F.lit(False))
    chain = F.when(
        F.coalesce(malformed, F.lit(True)) if malformed is not None else F.lit(False),
        "malformed",
    )
    chain = (
        chain.when(~F.col("quality").eqNullSafe(GOOD_QUALITY), "bad_quality")
        .when(F.col("value").isNull(), "null_value")
        .when(~known_type, "unknown_type")
        .when(~plausible, "out_of_range")
    )
    if clock_allowance is not None:
        latest = F.col("ingest_time") + F.expr(f"INTERVAL {clock_allowance}")
        chain = chain.when(F.col("timestamp") > latest, "future_clock")
    return chain


def _constraints(contract: dict[str, ColumnRule]) -> list[tuple[str, Column]]:
    """Every constraint as its name and the condition that breaks it."""
    found = []
    for name, rule in contract.items():
        if rule.required:
            found.append((f"{name}:null", F.col(name).isNull()))
        if rule.max_length is not None:
            found.append((f"{name}:length", F.length(name) > rule.max_length))
    return found


def breaks_contract(contract: dict[str, ColumnRule] = READING_CONTRACT) -> Column:
    """True when a row breaks any constraint, false when it conforms."""
    broken = [F.coalesce(condition, F.lit(False)) for _, condition in _constraints(contract)]
    return reduce(Column.__or__, broken, F.lit(False))


def contract_violations(contract: dict[str, ColumnRule] = READING_CONTRACT) -> Column:
    """The broken constraints of a row in contract order, comma-separated.

    ``<column>:null`` for a missing required value, ``<column>:length`` for text
    with more characters than allowed; empty when the row conforms.
    """
    return F.concat_ws(",", *[F.when(bad, name) for name, bad in _constraints(contract)])


def z_score(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations, NULL when they are 0."""
    return F.abs(value - mean) / F.nullif(stddev, F.lit(0.0))
