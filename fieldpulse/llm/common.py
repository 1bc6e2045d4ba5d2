"""Helpers the corpus operators share: column names, sizes, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldpulse.session import written

#: A table is only broadcast when its measured bytes stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, underscored until no column of ``df`` has that name (case ignored)."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 hashed bits of id and text, never null: rows that agree share them, others as good as never."""
    return F.struct(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("a"), F.xxhash64(F.lit(1), F.col(text), F.col(doc_id)).alias("b")
    )


def broadcast_if_small(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is below the bound.

    ``row_bytes`` estimates one row. Beyond the bound the planner chooses a
    shuffled join, so both forms give the same rows.
    """
    size = F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))
    measured = df.agg(size.alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if measured <= BROADCAST_BYTES else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller parts, so that a task makes the results of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _checksum(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list.

    Takes bigint columns ``a`` and ``b`` without nulls, in any direction, with
    repeats and self-loops allowed. Returns ``node``, ``component`` (the smallest
    node reachable) for every node that is not its component's smallest one.
    An empty edge list gives an empty result.

    Alternates the two star operations: each node first links its larger
    neighbours, then its smaller ones, to its smallest neighbour. Rounds grow
    with the logarithm of the nodes. Every round is a written table in the
    shared folder, so lineage stays short and lost executors cost one round.
    The minimum per node is written before it is joined: both join sides are then
    plain exchanges, which adaptive execution can split when a node is a hub.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(),
        "edges",
    )
    before = _checksum(current)
    while before["n"]:
        both = current.select("a", "b").union(current.select(F.col("b"), F.col("a")))
        smallest = written(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
            "smallest",
        )
        large = written(
            both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(),
            "large-star",
        )
        root = written(large.groupBy("a").agg(F.min("b").alias("m")), "roots")
        small = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(small.union(root.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = _checksum(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
