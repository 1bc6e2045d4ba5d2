"""Tumbling-window statistics, their mergeable form, and key-summing rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from fieldpulse.schema import GROUP_KEY, STATE_KEY

WINDOW = "5 minutes"
MEASURES = ["reading_count", "value_count", "mean", "m2", "min_value", "max_value"]


def window_moments(
    readings: DataFrame,
    window: str = WINDOW,
    by: list[str] = STATE_KEY,
    watermark: str | None = None,
) -> DataFrame:
    """Per window and group: rows, values, mean, m2 (summed squared deviation), min, max.

    NULL values are rows but no values, as in ``avg`` and ``stddev``.

    The form is mergeable, see :func:`merge_moments`.  Every aggregate has a
    fixed-width buffer, so tasks combine rows in a hash map before the shuffle
    and a busy sensor sends one row per task.  ``watermark`` is for streams.
    """
    if watermark is not None:
        readings = readings.withWatermark("timestamp", watermark)
    grouped = readings.groupBy(F.window("timestamp", window), *by).agg(*_measures())
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        *MEASURES,
    )


def _measures() -> list[Column]:
    return [
        F.count("*").alias("reading_count"),
        F.count("value").alias("value_count"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    ]


def group_moments(readings: DataFrame, by: list[str] = GROUP_KEY) -> DataFrame:
    """The moments of :func:`window_moments` per group over all time."""
    return readings.groupBy(*by).agg(*_measures())


def present_moments(
    moments: DataFrame, digits: int = 3, keep_moments: bool = False
) -> DataFrame:
    """Moments as avg, min, max, sample stddev (NULL for one value) and count.

    ``keep_moments`` adds ``value_count`` and the unrounded ``mean`` and ``m2``,
    which a stored row needs to be merged into longer windows later.
    """
    keys = [name for name in moments.columns if name not in MEASURES]
    stddev = F.when(F.col("value_count") > 1, F.sqrt(F.col("m2") / (F.col("value_count") - 1)))
    return moments.select(
        *keys,
        F.round("mean", digits).alias("avg_value"),
        F.round("min_value", digits).alias("min_value"),
        F.round("max_value", digits).alias("max_value"),
        F.round(stddev, digits).alias("stddev_value"),
        "reading_count",
        *(["value_count", "mean", "m2"] if keep_moments else []),
    )


def window_stats(
    readings: DataFrame, window: str = WINDOW, watermark: str | None = None, digits: int = 3
) -> DataFrame:
    """The window-statistics table: one row per window, device, sensor, location."""
    return present_moments(window_moments(readings, window, watermark=watermark), digits)


def merge_moments(moments: DataFrame, keys: list[str], via: list[str] = ()) -> DataFrame:
    """Moments of the union of the groups that share ``keys``.

    The squared deviations are taken from the merged mean, never as a difference
    of large sums, so narrow distributions far from zero keep their digits.
    The rows of a group meet in one task: meant for a bounded fan-in, as from
    windows to longer windows.  Where a group has very many rows, ``via`` names
    columns that divide it; the parts are merged first, then their results.
    """
    if via:
        return merge_moments(merge_moments(moments, [*keys, *via]), keys)
    group = Window.partitionBy(*keys)
    n, mean = F.col("value_count"), F.col("mean")
    # A part without values has no mean and adds nothing to either sum.
    total = F.nullif(F.sum(n).over(group), F.lit(0))
    # A group of one row keeps its digits.
    centre = F.when(F.count("*").over(group) == 1, mean).otherwise(F.sum(n * mean).over(group) / total)
    shifted = moments.withColumn("_mean", centre)
    return shifted.groupBy(*keys).agg(
        F.sum("reading_count").alias("reading_count"),
        F.sum("value_count").alias("value_count"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + n * (mean - F.col("_mean")) * (mean - F.col("_mean"))).alias("m2"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def rollup_windows(moments: DataFrame, window: str, by: list[str] = STATE_KEY) -> DataFrame:
    """Window moments merged into longer windows, such as 5 minutes into 1 hour."""
    span = F.window("window_start", window)
    wider = moments.select(
        span.getField("start").alias("window_start"),
        span.getField("end").alias("window_end"),
        *by,
        *MEASURES,
    )
    return merge_moments(wider, ["window_start", "window_end", *by])


def closed_windows(stats: DataFrame, newest: Column, watermark_minutes: int = 2) -> DataFrame:
    """Windows that end at or before the newest reading minus the watermark delay."""
    return stats.filter(
        F.col("window_end") <= newest - F.make_dt_interval(mins=F.lit(watermark_minutes))
    )


def rollup_sum(
    df: DataFrame,
    keys: list[str],
    sum_columns: list[str] | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Rows of equal key merged into one by adding up their numeric columns.

    ``sum_columns`` defaults to every numeric column outside the key.  The other
    columns come together from one row, the first in ``order_by`` (in their own
    order if it is not given).  Rows whose sums are all zero vanish.
    """
    if sum_columns is None:
        sum_columns = [
            f.name for f in df.schema
            if isinstance(f.dataType, NumericType) and f.name not in keys
        ]
    others = [name for name in df.columns if name not in [*keys, *sum_columns]]
    sums = [F.sum(name).alias(name) for name in sum_columns]
    if not others:
        merged = df.groupBy(*keys).agg(*sums)
    else:
        rank = [F.col(name).alias(f"_by{i}") for i, name in enumerate(order_by or [])]
        first_row = F.min(F.struct(*rank, *others)).alias("_first")
        merged = df.groupBy(*keys).agg(*sums, first_row)
    any_non_zero = F.lit(False)
    for name in sum_columns:
        any_non_zero = any_non_zero | (F.coalesce(F.col(name), F.lit(0)) != 0)
    kept = merged.filter(any_non_zero) if sum_columns else merged
    return kept.select(
        *[
            F.col(f"_first.{name}").alias(name) if name in others else F.col(name)
            for name in df.columns
        ]
    )

