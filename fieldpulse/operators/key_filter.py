"""Bloom filters of the keys that stored partitions hold, kept as tables of bitmaps.

A filter is cut into blocks of ``BLOCK_BITS`` bits. A key belongs to one block of its
partition and sets ``HASHES`` bits there, so a filter grows with its partition by rows of 4 KB
and a lookup is one equi-join. No key that is held is ever missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a block, fixed by the engine's bitmap functions.
BLOCK_BITS = 32_768
BITS_PER_KEY = 16
HASHES = 8
#: Fixed value: what the engine's writers call the partition of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

FILTER_DDL = "place STRING, blocks BIGINT, block BIGINT, bits BINARY"


def place(partition_by: list[str]) -> Column:
    """A partition as the name of its folder, without escapes: ``a=1/b=2``."""
    named = lambda name: F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(NO_VALUE))
    steps = [F.concat(F.lit(f"{name}="), named(name)) for name in partition_by]
    return F.concat_ws("/", *steps)


def _hashed(key: list[str], seed: str) -> Column:
    return F.xxhash64(F.lit(seed), *key)


def _block(blocks: Column, key: list[str]) -> Column:
    return F.pmod(_hashed(key, "block"), blocks)


def _place_in_block(key: list[str], seed: str) -> Column:
    return F.pmod(_hashed(key, seed), F.lit(BLOCK_BITS))


def _bit(first: Column, step: Column, number: int) -> Column:
    """One of the bits of a key within its block."""
    return F.pmod(first + number * step, F.lit(BLOCK_BITS))


def build(rows: DataFrame, partition_by: list[str], key: list[str]) -> DataFrame:
    """The filter of every partition in ``rows``.

    One short row per key is shuffled, by block, and sorted once: each hash sets its bits in a
    bitmap of its own, and the bitmaps of a block are laid together after that.
    """
    keys = rows.select(place(partition_by).alias("place"), *key)
    sizes = keys.groupBy("place").agg(
        F.ceil(F.count("*") * BITS_PER_KEY / BLOCK_BITS).cast("bigint").alias("blocks")
    )
    placed = keys.join(F.broadcast(sizes), "place").select(
        "place", "blocks", _block(F.col("blocks"), key).alias("block"),
        _place_in_block(key, "first").alias("first"), _place_in_block(key, "step").alias("step"),
    )
    blocks = ["place", "blocks", "block"]
    maps = [f"bits{n}" for n in range(HASHES)]
    made = placed.repartition(*blocks).groupBy(*blocks).agg(*[
        F.bitmap_construct_agg(_bit(F.col("first"), F.col("step"), n)).alias(name) for n, name in enumerate(maps)
    ])
    return made.select(*blocks, F.explode(F.array(*maps)).alias("bits")).groupBy(*blocks).agg(
        F.bitmap_or_agg("bits").alias("bits")
    )


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.call_function("shiftright", bit, F.lit(3)).cast("int") + 1, F.lit(1))), 16, 10)
    mask = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(F.lit(7)).cast("int"))
    return byte.cast("int").bitwiseAND(mask) != 0


def maybe_held(rows: DataFrame, filters: DataFrame, partition_by: list[str], key: list[str]) -> DataFrame:
    """The rows whose key one of the ``filters`` of its partition may hold; some are held by none.

    ``filters`` is any number of results of :func:`build`, also several of one partition.
    The bits are tested one by one in compiled code, so that no row carries its block along.
    """
    sizes = filters.select("place", "blocks").distinct()
    asked = rows.withColumn("place", place(partition_by)).join(F.broadcast(sizes), "place").withColumns({
        "block": _block(F.col("blocks"), key),
        "first": _place_in_block(key, "first"), "step": _place_in_block(key, "step"),
    })
    held = asked.join(filters, ["place", "blocks", "block"])
    for number in range(HASHES):
        held = held.filter(_is_set(F.col("bits"), _bit(F.col("first"), F.col("step"), number)))
    return held.select("place", *rows.columns)
