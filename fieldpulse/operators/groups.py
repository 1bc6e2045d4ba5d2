"""Attaching a group's row to each of its members, however uneven the groups are."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from fieldpulse.session import written

# A table of group rows up to this many bytes is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A group with more than 1/SHARES of all rows, and more than HOT_ROWS, is hot.
# Fewer than SHARES groups can be, so a table of the hot ones is small.
SHARES = 65_536
HOT_ROWS = 1_000_000


def table_bytes(df: DataFrame) -> int:
    """Measured size of a table of numbers, times and text as rows in memory."""
    width = F.lit(64)
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            width = width + 16 + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            width = width + 16
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def hot_limit(
    groups: DataFrame,
    size: str,
    shares: int = SHARES,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> int:
    """Groups with more rows than this are hot.

    There are fewer than ``shares`` of them, and if their table is still too
    big to broadcast, because of long keys, the limit is raised until it is not.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    limit = max(total // shares, hot_rows, 1)
    while table_bytes(groups.filter(F.col(size) > limit)) > broadcast_bytes:
        limit *= 2
    return limit


def attach_group_rows(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    size: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    shares: int = SHARES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, an aggregate of the same rows by ``keys``.

    ``size`` names the column of ``groups`` with the number of rows per group.
    The group table is written once and measured.  If it is small it is
    broadcast and ``rows`` are not shuffled at all.  Otherwise only the rows of
    ordinary groups are shuffled; the rows of the hot groups, of which there are
    fewer than ``shares``, stay where they are and meet a broadcast list.
    """
    groups = written(groups.dropna(subset=keys), "groups")
    if table_bytes(groups) <= broadcast_bytes:
        return rows.join(F.broadcast(groups), keys)
    limit = hot_limit(groups, size, shares, hot_rows, broadcast_bytes)
    if groups.filter(F.col(size) > limit).isEmpty():
        return rows.join(groups, keys)
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    ordinary = groups.filter(F.col(size) <= limit)
    stay = rows.join(hot, keys)
    move = rows.join(hot.select(*keys), keys, "left_anti").join(ordinary, keys)
    return stay.unionByName(move)


def split_hot_groups(
    rows: DataFrame,
    keys: list[str],
    shares: int = SHARES,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` as (rows of ordinary groups, rows of hot groups or None).

    Group sizes are counted first; the list of hot keys has fewer than
    ``shares`` rows and is broadcast.  Rows with a NULL key are in neither part.
    """
    rows = rows.dropna(subset=keys)
    sizes = written(rows.groupBy(*keys).agg(F.count("*").alias("_n")), "sizes")
    hot = sizes.filter(F.col("_n") > hot_limit(sizes, "_n", shares, hot_rows)).select(*keys)
    if hot.isEmpty():
        return rows, None
    listed = F.broadcast(hot)
    return rows.join(listed, keys, "left_anti"), rows.join(listed, keys, "left_semi")
