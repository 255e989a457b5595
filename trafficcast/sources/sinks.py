"""Result tables: replaced, latest-run and history sinks, and the run log.

All are Parquet folders, so they outlive the session and its catalog. Writes
repeat safely: a second run of one day replaces that day's rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trafficcast.functions.columns import minutes
from trafficcast.schemas import RUN_LOG
from trafficcast.sources.files import drop_partition, partitions, table_exists


def write_replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _write_run(df: DataFrame, path: str, run_date: dt.date, replace: bool) -> None:
    dated = df.drop("run_date").withColumn("run_date", F.lit(run_date))
    mode = "static" if replace else "dynamic"
    dated.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
        "run_date"
    ).parquet(path)


def write_latest(df: DataFrame, path: str, run_date: dt.date, replace: bool = False) -> None:
    """Only this run survives; older ones go once it is written."""
    _write_run(df, path, run_date, replace)
    spark = df.sparkSession
    for old in partitions(spark, path, "run_date"):
        if old != run_date.isoformat():
            drop_partition(spark, path, "run_date", old)


def write_history(df: DataFrame, path: str, run_date: dt.date, replace: bool = False) -> None:
    """Accumulates runs, unless told to replace the table."""
    _write_run(df, path, run_date, replace)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest run. Folder names tell which it is, so only that partition is scanned."""
    runs = partitions(spark, path, "run_date")
    table = spark.read.parquet(path)
    return table.filter(F.col("run_date") == F.lit(runs[-1]).cast("date")) if runs else table


def run_dates(table: DataFrame) -> DataFrame:
    return table.select("run_date").distinct()


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted by the job that computes them; `get["rows"]` of the observation waits for it."""
    watch = Observation()
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def log_run(
    spark: SparkSession,
    path: str,
    report: str,
    horizon: str,
    seconds: float,
    run_date: dt.date,
    rows: Mapping[str, int] | None = None,
) -> None:
    """Appends the minutes a report took and the rows it wrote, by kind of table; NULL where it wrote none."""
    rows = rows or {}
    counts = [
        F.lit(rows.get(f.name.removesuffix("_rows"))).cast(f.dataType).alias(f.name)
        for f in RUN_LOG.fields
        if f.name.endswith("_rows")
    ]
    entry = spark.range(1).select(
        F.lit(report).alias("report"),
        F.lit(horizon).alias("horizon"),
        minutes(seconds).alias("run_time"),
        F.lit(run_date).alias("run_date"),
        *counts,
    )
    entry.coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], RUN_LOG)
    return spark.read.schema(RUN_LOG).parquet(path)
