"""Scans of the stored tables and loads from outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.functions.columns import event_date
from trafficcast.schemas import ATTRIBUTE, ATTRIBUTE_COLUMNS, BATCH, DATAPOINT, PARTITION, stored


def read_datapoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(stored(DATAPOINT)).parquet(path).drop(BATCH.name)


def read_attributes(spark: SparkSession, path: str, with_time: bool = False) -> DataFrame:
    """Device attributes, cut to the columns the reports join; the time only on demand."""
    extra = ["time_stamp"] if with_time else []
    return spark.read.schema(stored(ATTRIBUTE)).parquet(path).select(*ATTRIBUTE_COLUMNS, *extra)


def open_source(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """A table outside the store; format and connection options are the caller's."""
    return spark.read.format(fmt).options(**options).load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; spaces in column names are dropped. Types are inferred without a schema."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    raw = reader.csv(path)
    return raw.toDF(*[c.replace(" ", "") for c in raw.columns])


def load_csv(
    spark: SparkSession, path: str, table_path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Appends a CSV to a table and returns the table."""
    read_csv(spark, path, schema).write.mode("append").parquet(table_path)
    return spark.read.parquet(table_path)


def pull_window(source: DataFrame, lo: Column | int, hi: Column | int, closed: str = "left") -> DataFrame:
    """Rows between two times (epoch milliseconds); `closed` names the bound that is included.

    The bounds are plain comparisons, so file and database sources get them pushed down. On a stored
    table they become bounds of its dates as well, and no other folder is read.
    """
    ts, source = F.col("time_stamp"), on_dates(source, lo, hi)
    if closed == "left":
        return source.filter((ts >= lo) & (ts < hi))
    if closed == "right":
        return source.filter((ts > lo) & (ts <= hi))
    raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")


def on_dates(stored_points: DataFrame, lo: Column | int, hi: Column | int | None = None) -> DataFrame:
    """The rows whose `event_date` may hold times from lo to hi (epoch milliseconds); all, if there is no such column."""
    if PARTITION.name not in stored_points.columns:
        return stored_points
    bounds = F.col(PARTITION.name) >= event_date(F.lit(lo))
    if hi is not None:
        bounds &= F.col(PARTITION.name) <= event_date(F.lit(hi))
    return stored_points.filter(bounds)
