"""The few file-system calls the tables need, on whatever store a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; what is above the target is created."""
    fs, source = _open(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise OSError(f"{path} could not be moved to {target}")


def numbered_folders(spark: SparkSession, path: str, column: str) -> list[int]:
    """The N of every ``column=N`` folder below ``path``, ascending."""
    prefix = f"{column}="
    return sorted(
        int(name[len(prefix):])
        for name in child_folders(spark, path)
        if name.startswith(prefix)
    )


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, target = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or [])


def modified(spark: SparkSession, path: str) -> float | None:
    """When a file was last written, in seconds since 1970; None if it does not exist."""
    fs, target = _open(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000 if fs.exists(target) else None


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there already."""
    fs, target = _open(spark, path)
    if fs.exists(target):
        return False
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one that is there."""
    fs, target = _open(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    source = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()
