"""Whole-folder operations on the file system a path lies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there: files or partitions, not just what a failed job left."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, from the folder names alone."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    drop_folder(spark, f"{path.rstrip('/')}/{column}={value}")
