"""Sorted and top-k results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sorted_rows(df: DataFrame, *order: Column) -> DataFrame:
    """A total order that spreads over tasks even if many rows tie.

    Range partitioning keeps equal sort keys in one task.  A hash of the row
    and then its number break ties, so even a run of copies can be cut.  The
    number only decides between copies; let rows that have copies come from a
    scan, where a repeated task numbers them alike.
    """
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    return numbered.orderBy(*order, F.xxhash64(*df.columns), F.col("_tie")).drop("_tie")


def newest_first(df: DataFrame, time: str = "timestamp", ties: list[str] = ()) -> DataFrame:
    """Rows by time, latest first."""
    return sorted_rows(df, F.col(time).desc(), *[F.col(name) for name in ties])


def top_newest(df: DataFrame, n: int, time: str = "timestamp", ties: list[str] = ()) -> DataFrame:
    """The ``n`` latest rows; each task keeps only its own ``n``."""
    return df.orderBy(F.col(time).desc(), *[F.col(name) for name in ties]).limit(n)
