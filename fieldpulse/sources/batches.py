"""Tables that a stream appends to, one folder per micro-batch.

A table folder holds

* ``fresh/batch_id=N``: the output of micro-batch N, overwritten if it is retried;
* ``settled/upto=M``: the batches up to M gathered into few, well-sorted files; in a
  table settled by partition, the partitions written whole up to then;
* ``added/upto=M``: rows that came to partitions without a change to what these held;
* ``filters/upto=M``: Bloom filters of the keys in both;
* ``owners/N``: the streams that wrote the table, the last one with the right to.

A folder counts once Spark has put its ``_SUCCESS`` marker there, so a reader
never sees half a batch, and the marker of a settled folder is the switch that
replaces the fresh ones it was made from, and brings in what was added with it.

Batch numbers belong to a stream's checkpoint. A stream records itself as the
owner with its first batch, and any other, or the same one with a new
checkpoint, is refused until :func:`take_over` lets it go on above what is there.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fieldpulse import storage
from fieldpulse.operators import key_filter
from fieldpulse.session import written

#: Rows a file is made for where adaptive execution cannot size files.
FILE_ROWS = 2_000_000
#: Shuffled bytes a file of a fresh batch is made for; settling gathers them into bigger ones.
FRESH_BYTES = 16 * 1024 * 1024
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Folders a settled partition may consist of before it is written whole again.
LAYERS = 8
#: One key in so many is looked up first: a partition that holds one of these is merged anyway.
PROBED = 64


def fresh_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the completely written micro-batches."""
    return _complete(spark, f"{path}/fresh", "batch_id")


def settled_marks(spark: SparkSession, path: str) -> list[int]:
    """Last batch number of every completely written settled folder."""
    return _complete(spark, f"{path}/settled", "upto")


def _complete(spark: SparkSession, folder: str, column: str) -> list[int]:
    marks = storage.matching(spark, f"{folder}/{column}=*/_SUCCESS")
    return sorted(int(mark.split("/")[-2].partition("=")[2]) for mark in marks)


# --- Owners -----------------------------------------------------------------


def _owners(spark: SparkSession, path: str) -> list[dict]:
    """The records of a table's streams, oldest first: ``query`` and the ``first`` number it got."""
    files = sorted(storage.matching(spark, f"{path}/owners/*"), key=lambda f: int(f.rpartition("/")[2]))
    return [json.loads(storage.read_text(spark, file)) for file in files]


def _record(spark: SparkSession, path: str, number: int, query: str | None, first: int) -> None:
    if not storage.write_new(spark, f"{path}/owners/{number}", json.dumps({"query": query, "first": first})):
        raise ValueError(f"{path} was claimed by another stream at the same time")


def _last_number(spark: SparkSession, path: str) -> int:
    """The highest number any batch folder has, complete or not."""
    numbers = storage.numbered_folders(spark, f"{path}/fresh", "batch_id")
    return max([*numbers, *settled_marks(spark, path)], default=-1)


def _first_number(spark: SparkSession, path: str, query: str | None) -> int:
    """Number of the writing stream's batch 0; refuses a stream the table does not belong to."""
    owners = _owners(spark, path)
    if query is None and not owners:
        return 0  # written by hand, not by a stream
    if owners and owners[-1]["query"] == query is not None:
        return owners[-1]["first"]
    if query is not None and owners and owners[-1]["query"] is None:
        _record(spark, path, len(owners), query, owners[-1]["first"])
        return owners[-1]["first"]
    if query is not None and not owners and _last_number(spark, path) < 0:
        _record(spark, path, 0, query, 0)
        return 0
    raise ValueError(
        f"{path} belongs to another stream, or its stream's checkpoint was reset; its batches would be "
        "overwritten. Start on a new table, or call take_over to go on above what is stored"
    )


def take_over(spark: SparkSession, path: str) -> int:
    """Give the table to the stream that writes next; its batches follow the stored ones.

    The former owner must have ended; it is refused from now on.  Returns the
    number the new stream's batch 0 gets.
    """
    first = _last_number(spark, path) + 1
    _record(spark, path, len(_owners(spark, path)), None, first)
    return first


# --- Writing ----------------------------------------------------------------


def batch_number(spark: SparkSession, path: str, batch_id: int) -> int:
    """The number a micro-batch has in the table, which is claimed for its stream."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return _first_number(spark, path, query) + batch_id


def append_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    partition_by: list[str] = (),
    sort_by: list[str] = (),
) -> None:
    """Write one micro-batch; writing the same batch again replaces it.

    Within a stream the table is claimed for its query.
    """
    spark = df.sparkSession
    number = batch_number(spark, path, batch_id)
    marks = settled_marks(spark, path)
    if marks and number <= marks[-1]:
        raise ValueError(
            f"batch {number} of {path} is settled up to {marks[-1]}; was the stream's "
            "checkpoint reset? Start it on a new table"
        )
    usual = spark.conf.get(_ADVISORY, None)
    spark.conf.set(_ADVISORY, str(FRESH_BYTES))
    try:
        _write(df, f"{path}/fresh/batch_id={number}", partition_by, sort_by)
    finally:
        if usual is None:
            spark.conf.unset(_ADVISORY)
        else:
            spark.conf.set(_ADVISORY, usual)


def _write(df: DataFrame, target: str, partition_by: list[str], sort_by: list[str]) -> None:
    """Few files per partition, and several for an oversized one.

    Rebalancing does it where execution is adaptive.  In the batches of a
    stateful stream it is not: there the rows are counted, and a salt cuts each
    partition into as many files as all rows would need.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        arranged = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    else:
        files = 1 + df.count() // FILE_ROWS
        salt = F.pmod(F.xxhash64(*(sort_by or df.columns)), F.lit(files))
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        arranged = df.repartition(min(tasks, 8 * files), *partition_by, salt)
    order = [*partition_by, *sort_by]
    if order:
        arranged = arranged.sortWithinPartitions(*order)
    writer = arranged.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)


# --- Reading ----------------------------------------------------------------


def read_batches(spark: SparkSession, path: str, ddl: str, cumulative: bool = False) -> DataFrame:
    """All rows of the table; ``ddl`` lists its columns, partition columns included.

    In a ``cumulative`` table the newest settled folder already contains the
    earlier ones.
    """
    marks = settled_marks(spark, path)
    done = marks[-1] if marks else -1
    settled = marks[-1:] if cumulative else marks
    fresh = [n for n in fresh_batches(spark, path) if n > done]
    rows = _together(
        _read(spark, f"{path}/settled", [f"upto={n}" for n in settled], ddl) if settled else None,
        _read(spark, f"{path}/fresh", [f"batch_id={n}" for n in fresh], ddl) if fresh else None,
    )
    return spark.createDataFrame([], ddl) if rows is None else rows


def _read(spark: SparkSession, base: str, folders: list[str], ddl: str) -> DataFrame:
    reader = spark.read.schema(ddl).option("basePath", base)
    found = reader.parquet(*[f"{base}/{folder}" for folder in folders])
    return found.select(*StructType.fromDDL(ddl).names)


# --- Upkeep -----------------------------------------------------------------


def settle(
    spark: SparkSession,
    path: str,
    ddl: str,
    merge: Callable[[DataFrame], DataFrame],
    cumulative: bool = False,
    partition_by: list[str] = (),
    sort_by: list[str] = (),
    upto: int | None = None,
) -> int | None:
    """Gather the fresh batches up to ``upto`` into one settled folder.

    ``merge`` reduces their rows.  ``upto`` defaults to the last batch but one,
    because a restarted stream may write its last batch again.  Returns the new
    mark, or None when there was nothing to do.  A run that dies half way leaves
    the table as it was.
    """
    marks = settled_marks(spark, path)
    done = marks[-1] if marks else -1
    fresh = fresh_batches(spark, path)
    limit = upto if upto is not None else (fresh[-1] - 1 if fresh else -1)
    gathered = [n for n in fresh if done < n <= limit]
    if not gathered:
        return None
    rows = _read(spark, f"{path}/fresh", [f"batch_id={n}" for n in gathered], ddl)
    if cumulative and marks:
        rows = rows.unionByName(_read(spark, f"{path}/settled", [f"upto={done}"], ddl))
    mark = gathered[-1]
    _write(merge(rows), f"{path}/settled/upto={mark}", partition_by, sort_by)
    return mark


def _partitions(spark: SparkSession, path: str, kind: str, depth: int) -> dict[int, dict[str, str]]:
    """Per complete batch, settled or added folder its partitions: ``a=1/b=2`` and the whole path."""
    column, numbers = ("batch_id", fresh_batches) if kind == "fresh" else ("upto", settled_marks)
    found: dict[int, dict[str, str]] = {n: {} for n in numbers(spark, path)}
    for folder in storage.matching(spark, f"{path}/{kind}/{column}=*" + "/*=*" * depth):
        steps = folder.split("/")
        number = int(steps[-depth - 1].partition("=")[2])
        if number in found:
            found[number]["/".join(steps[-depth:])] = folder
    return found


def live_folders(spark: SparkSession, path: str, depth: int) -> dict[str, list[str]]:
    """The folders that count for each settled partition: the last one written whole, and what was added since."""
    whole, added = (_partitions(spark, path, kind, depth) for kind in ("settled", "added"))
    live: dict[str, list[str]] = {}
    for mark in sorted(whole):
        live |= {name: [folder] for name, folder in whole[mark].items()}
        for name, folder in added[mark].items():
            live.setdefault(name, []).append(folder)
    return live


def mark_of(folder: str, depth: int) -> int:
    """The number of a settled or added partition folder."""
    return int(folder.split("/")[-depth - 1].partition("=")[2])


def _read_folders(spark: SparkSession, path: str, folders: list[str], ddl: str) -> DataFrame | None:
    """Rows of settled and added partition folders."""
    parts = []
    for kind in ("settled", "added"):
        base = f"{path}/{kind}"
        if chosen := sorted(f for f in folders if f"/{kind}/upto=" in f):
            found = spark.read.schema(ddl).option("basePath", base).parquet(*chosen)
            parts.append(found.select(*StructType.fromDDL(ddl).names))
    return _together(*parts)


def _together(*parts: DataFrame | None) -> DataFrame | None:
    present = [part for part in parts if part is not None]
    return present[0] if len(present) == 1 else present[0].unionByName(present[1]) if present else None


def _all(folders: dict[str, list[str]], names) -> list[str]:
    return [folder for name in names for folder in folders[name]]


def settle_partitions(
    spark: SparkSession,
    path: str,
    ddl: str,
    merge: Callable[[DataFrame], DataFrame] | None,
    partition_by: list[str],
    sort_by: list[str] = (),
    upto: int | None = None,
    key: list[str] = (),
) -> int | None:
    """Like :func:`settle` for a table whose rows are merged by key within a partition.

    The partitions that fresh rows touch are merged with what is settled of them
    and written whole, so every settled partition is merged for good.  The
    others stay where they are; cost follows the partitions touched.

    With ``key``, the columns rows are merged by within a partition, Bloom filters
    are kept.  Where they exclude every fresh key, the fresh rows are added to the
    partition and nothing of it is read; where they do not, the settled keys alone
    are read to find out.  Without a ``merge`` no row concerns another, and all are
    added.  A partition of ``LAYERS`` folders is written whole.
    """
    depth = len(partition_by)
    marks = settled_marks(spark, path)
    done = marks[-1] if marks else -1
    fresh = _partitions(spark, path, "fresh", depth)
    limit = upto if upto is not None else max(fresh, default=0) - 1
    gathered = [n for n in sorted(fresh) if done < n <= limit]
    if not gathered:
        return None
    mark = gathered[-1]
    for kind in ("added", "filters"):  # left by a run that died
        storage.delete(spark, f"{path}/{kind}/upto={mark}")
    live = live_folders(spark, path, depth)
    arrived = {name: [fresh[n][name] for n in gathered if name in fresh[n]] for n in gathered for name in fresh[n]}
    known = arrived.keys() & live.keys()
    base = f"{path}/fresh"
    read = lambda names: spark.read.schema(ddl).option("basePath", base).parquet(*sorted(_all(arrived, names))).select(
        *StructType.fromDDL(ddl).names
    )
    again = {name for name in known if len(live[name]) >= LAYERS}
    if merge and key and known - again:
        again |= _holding(spark, path, ddl, read, live, known - again, partition_by, key)
    elif merge and not key:
        again = known
    merged = merge or (lambda rows: rows)
    if added := known - again:
        _write(merged(read(added)), f"{path}/added/upto={mark}", partition_by, sort_by)
    rest = arrived.keys() - added
    rows = _together(
        read(rest) if rest else read(added).filter(F.lit(False)),
        _read_folders(spark, path, _all(live, again), ddl),
    )
    _write(merged(rows), f"{path}/settled/upto={mark}", partition_by, sort_by)
    if key:
        placed = [folders[mark] for kind in ("settled", "added") if (folders := _partitions(spark, path, kind, depth))[mark]]
        rows = _read_folders(spark, path, [folder for folders in placed for folder in folders.values()], ddl)
        if rows is not None:
            key_filter.build(rows, partition_by, key).write.mode("overwrite").parquet(f"{path}/filters/upto={mark}")
    return mark


def _holding(
    spark: SparkSession, path: str, ddl: str, read: Callable[[set[str]], DataFrame], live: dict[str, list[str]],
    known: set[str], partition_by: list[str], key: list[str],
) -> set[str]:
    """The partitions among ``known`` that hold the key of one of their rows from ``read``.

    A share of the keys is looked up first, the others for partitions that hold none of it.
    """
    few = F.pmod(F.xxhash64(*key), F.lit(PROBED)) == 0
    found: set[str] = set()
    for share in (few, ~few):
        if left := known - found:
            found |= _holding_share(spark, path, ddl, read(left), live, left, partition_by, key, share)
    return found


def _holding_share(
    spark: SparkSession, path: str, ddl: str, rows: DataFrame, live: dict[str, list[str]], known: set[str],
    partition_by: list[str], key: list[str], share: Column,
) -> set[str]:
    """The partitions among ``known`` that hold the key of one of ``rows``, of the keys in ``share``."""
    depth = len(partition_by)
    filtered = set(_complete(spark, f"{path}/filters", "upto"))
    marks = {name: {mark_of(folder, depth) for folder in live[name]} for name in known}
    open_to_all = {name for name in known if marks[name] - filtered}
    asked = rows.filter(share).select(*partition_by, *key).distinct()
    place = key_filter.place(partition_by)
    suspects = asked.filter(place.isin([unquote(name) for name in open_to_all])).select(place.alias("place"), "*")
    if needed := {mark for name in known - open_to_all for mark in marks[name]}:
        filters = spark.read.schema(key_filter.FILTER_DDL).parquet(
            *[f"{path}/filters/upto={mark}" for mark in sorted(needed)]
        ).filter(F.col("place").isin([unquote(name) for name in known - open_to_all]))
        suspects = suspects.union(key_filter.maybe_held(asked, filters, partition_by, key))
    suspects = written(suspects, "suspects")
    doubtful = {row["place"] for row in suspects.select("place").distinct().collect()}
    if not doubtful:
        return set()
    folders = _all(live, [name for name in known if unquote(name) in doubtful])
    held = _read_folders(spark, path, folders, ddl).filter(share).select(place.alias("place"), *key).alias("held")
    same = F.col("asked.place") == F.col("held.place")
    for name in key:
        same = same & F.col(f"asked.{name}").eqNullSafe(F.col(f"held.{name}"))
    sure = suspects.alias("asked").join(held, same, "left_semi").select("place").distinct().collect()
    found = {row["place"] for row in sure}
    return {name for name in known if unquote(name) in found}


def read_merged(
    spark: SparkSession, path: str, ddl: str, depth: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of partitions that are merged for good, and rows that have yet to be merged.

    The second part holds the fresh rows and the settled ones of the same partitions.
    """
    marks = settled_marks(spark, path)
    done = marks[-1] if marks else -1
    fresh = {n: f for n, f in _partitions(spark, path, "fresh", depth).items() if n > done}
    touched = {name for folders in fresh.values() for name in folders}
    live = live_folders(spark, path, depth)
    merged = _read_folders(spark, path, _all(live, live.keys() - touched), ddl)
    return merged, _together(
        _read(spark, f"{path}/fresh", [f"batch_id={n}" for n in sorted(fresh)], ddl) if fresh else None,
        _read_folders(spark, path, _all(live, live.keys() & touched), ddl),
    )


def vacuum(
    spark: SparkSession, path: str, cumulative: bool = False, depth: int = 0, grace_seconds: float = 0
) -> None:
    """Delete folders that a settled one has replaced; run it when no old reader is left.

    ``depth`` is the number of partition columns of a table settled by partition.
    ``grace_seconds`` spares what was replaced less than that long ago, for readers
    that listed the table before.
    """
    marks = settled_marks(spark, path)
    now = time.time()
    settled_at = {mark: storage.modified(spark, f"{path}/settled/upto={mark}/_SUCCESS") for mark in marks}
    past = [mark for mark in marks if now - settled_at[mark] >= grace_seconds]
    if not past:
        return
    for n in storage.numbered_folders(spark, f"{path}/fresh", "batch_id"):
        if n <= past[-1]:
            storage.delete(spark, f"{path}/fresh/batch_id={n}")
    for mark in past[:-1] if cumulative else []:
        storage.delete(spark, f"{path}/settled/upto={mark}")
    if depth:
        _vacuum_partitions(spark, path, depth, set(past))


def _vacuum_partitions(spark: SparkSession, path: str, depth: int, past: set[int]) -> None:
    """Delete the partition folders that one written whole by a mark of ``past`` has replaced."""
    whole, added = (_partitions(spark, path, kind, depth) for kind in ("settled", "added"))
    last_whole: dict[str, int] = {}
    for mark in sorted(whole.keys() & past):
        last_whole |= dict.fromkeys(whole[mark], mark)
    for mark in whole:
        left = 0
        for kind, folders in (("settled", whole[mark]), ("added", added[mark])):
            for name, folder in folders.items():
                if mark < last_whole.get(name, -1):
                    storage.delete(spark, folder)
                else:
                    left += 1
        if not left and mark != max(whole):
            for kind in ("settled", "added", "filters"):
                storage.delete(spark, f"{path}/{kind}/upto={mark}")


def drop_days_before(spark: SparkSession, path: str, first_kept: date) -> int:
    """Delete the ``event_day`` partitions of earlier days; returns how many."""
    dropped = 0
    for kind in ("fresh", "settled", "added"):
        for folder in storage.matching(spark, f"{path}/{kind}/*/event_day=*"):
            day = folder.rpartition("=")[2]
            if day[:4].isdigit() and date.fromisoformat(day) < first_kept:
                storage.delete(spark, folder)
                dropped += 1
    return dropped


def day_filter(df: DataFrame, since=None, until=None) -> DataFrame:
    """Rows of the days from ``since`` to ``until``, both included, by partition."""
    if since is not None:
        df = df.filter(F.col("event_day") >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col("event_day") <= F.lit(until).cast("date"))
    return df
