"""Tables whose files cover narrow ranges of a key, kept so as rows are added.

Every append writes files in ranges of its own rows, and ranges of different appends overlap:
a reader of one device and day meets a file of each. :func:`recluster` finds the files that
overlap by a sweep over their ranges and writes only those anew; the others stay as they are.

A table folder holds ``parts/part=N`` with files, and ``versions/N``, the list of the files
that make up the table with the range of each. A version counts once it is complete, and
the last one is the table: a reader never sees files twice or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from fieldpulse import storage
from fieldpulse.functions.instants import utc_date
from fieldpulse.session import written

#: Files that may cover one point of the key before they are written anew.
DEPTH = 4


def _key(time: str) -> list[Column]:
    """The order of a table: sensor type and UTC day, then device and time."""
    return [
        F.col("sensor_type").alias("sensor_type"), utc_date(F.col(time)).alias("day"),
        F.col("device_id").alias("device_id"), F.col(time).alias("time"),
    ]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions."""
    return [
        n for n in storage.numbered_folders(spark, f"{path}/versions", "version")
        if storage.exists(spark, f"{path}/versions/version={n}/_SUCCESS")
    ]


def files(spark: SparkSession, path: str) -> DataFrame | None:
    """The files of the table: ``file``, ``low`` and ``high`` of the key, ``rows``; None if there are none."""
    made = versions(spark, path)
    return spark.read.parquet(f"{path}/versions/version={made[-1]}") if made else None


def _write_part(df: DataFrame, path: str, time: str) -> str:
    """Write rows in ranges of the key; returns the part's folder."""
    spark = df.sparkSession
    taken = storage.numbered_folders(spark, f"{path}/parts", "part")
    target = f"{path}/parts/part={max(taken, default=-1) + 1}"
    key = _key(time)
    # A row number continues the key, so that one instant of one device is cut as well.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*key, F.col("_row")).sortWithinPartitions(*key).drop("_row")
    ranged.write.mode("errorifexists").parquet(target)
    return target


def _ranges(spark: SparkSession, folder: str, schema: StructType, time: str) -> DataFrame:
    """The range of every file of a part; reads the key's columns only."""
    place = F.struct(*_key(time))
    return spark.read.schema(schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("rows")
    )


def _commit(listed: DataFrame, path: str) -> None:
    spark = listed.sparkSession
    number = max(storage.numbered_folders(spark, f"{path}/versions", "version"), default=-1) + 1
    listed.write.mode("errorifexists").parquet(f"{path}/versions/version={number}")


def append_clustered(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Add rows as files of their own; what is there is neither read nor written."""
    spark = df.sparkSession
    part = _write_part(df, path, time)
    added = _ranges(spark, part, df.schema, time)
    before = files(spark, path)
    _commit(added if before is None else before.unionByName(added), path)


def read_clustered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the table."""
    listed = files(spark, path)
    names = [row["file"] for row in listed.select("file").collect()] if listed is not None else []
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def overlaps(listed: DataFrame) -> DataFrame:
    """``files`` with the ``chain`` each belongs to and the chain's ``depth``.

    Files whose ranges overlap, one after the other, are a chain; ranges that only touch do
    not overlap. The depth is the largest number of files over one point. One row a file is
    swept, in one order; rows of the table are not touched.
    """
    swept = Window.orderBy("low", "high", "file")
    before = swept.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.max("high").over(before) <= F.col("low"), F.lit(True))
    chained = listed.withColumn("starts", starts.cast("int")).withColumn("chain", F.sum("starts").over(swept)).drop("starts")
    # At one point files end before others begin; a file of a single point counts for itself.
    ends = chained.select("chain", F.col("high").alias("at"), F.lit(-1).alias("step"))
    begins = chained.select("chain", F.col("low").alias("at"), F.lit(1).alias("step"))
    along = Window.partitionBy("chain").orderBy("at", "step")
    depth = begins.union(ends).withColumn("open", F.sum("step").over(along)).groupBy("chain").agg(
        F.greatest(F.max("open"), F.lit(1)).alias("depth")
    )
    return chained.join(depth, "chain")


def recluster(
    spark: SparkSession, path: str, schema: StructType, depth: int = DEPTH, time: str = "timestamp"
) -> int:
    """Write the files anew that lie in chains deeper than ``depth``; returns how many.

    A run that dies half way leaves the table as it was.
    """
    listed = files(spark, path)
    if listed is None:
        return 0
    judged = written(overlaps(listed), "overlaps")
    deep = judged.filter(F.col("depth") > depth)
    names = [row["file"] for row in deep.select("file").collect()]
    if not names:
        return 0
    part = _write_part(spark.read.schema(schema).parquet(*names), path, time)
    stay = judged.filter(F.col("depth") <= depth).select(*listed.columns)
    _commit(stay.unionByName(_ranges(spark, part, schema, time)), path)
    return len(names)


def vacuum_clustered(spark: SparkSession, path: str) -> None:
    """Delete versions before the last and files it does not list; run it when no old reader is left."""
    made = versions(spark, path)
    if not made:
        return
    live = {row["file"].rpartition("/parts/")[2] for row in files(spark, path).select("file").collect()}
    for file in storage.matching(spark, f"{path}/parts/part=*/*.parquet"):
        if file.rpartition("/parts/")[2] not in live:
            storage.delete(spark, file)
    for number in storage.numbered_folders(spark, f"{path}/versions", "version"):
        if number < made[-1]:
            storage.delete(spark, f"{path}/versions/version={number}")

