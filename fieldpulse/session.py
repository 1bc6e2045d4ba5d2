"""Session set-up and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldpulse import storage


def build_session(
    app_name: str = "fieldpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    rocksdb_state: bool = True,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``shuffle_partitions`` also fixes the number of state-store partitions of a
    streaming query at its first checkpoint, so size it for the stream's life.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if rocksdb_state:
        builder = builder.config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configured_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """:func:`configured_folder`; a local master, which shares its disk, may go without.

    For intermediates only: what has to outlive the application, such as the
    checkpoint of a stream, needs a folder that was named.
    """
    try:
        return configured_folder(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return f"/tmp/fieldpulse-{spark.sparkContext.applicationId}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/fieldpulse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage so that a result used several times is computed once, and
    survives the loss of executors because it does not live on them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under :func:`scratch_path`.

    To be called at the end: results that were read back need their files.
    """
    storage.delete(spark, _scratch_root(spark))
