"""Bootstrap, incremental append and retention of the stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.constants import MS_PER_DAY, RETENTION_DAYS
from trafficcast.functions.columns import event_date
from trafficcast.schemas import APPEND_LOG, BATCH, PARTITION, stored
from trafficcast.sources.files import drop_partition, partitions, table_exists
from trafficcast.sources.tables import on_dates, pull_window


def high_water_mark(points: DataFrame) -> DataFrame:
    """Latest stored time as one row."""
    return points.agg(F.max("time_stamp").alias("time_stamp"))


def after_mark(source: DataFrame, stored_points: DataFrame) -> DataFrame:
    """Rows newer than anything stored; the mark is a scalar the scan can filter by."""
    return source.filter(F.col("time_stamp") > high_water_mark(stored_points).scalar())


def pending_points(source: DataFrame, stored_points: DataFrame) -> DataFrame:
    """Number of distinct times waiting above the mark."""
    return after_mark(source, stored_points).agg(F.count_distinct("time_stamp").alias("count"))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Names, order and types of the stored table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def midnight_ms(day: dt.date) -> int:
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()) * 1000


def bootstrap_window(source: DataFrame, today: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """The given number of whole days before today; today itself is left out."""
    end = midnight_ms(today)
    return pull_window(source, end - days * MS_PER_DAY, end, closed="left")


def retained(points: DataFrame, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last days before the latest stored time, that time included; older dates are not read."""
    floor = high_water_mark(points).select(F.col("time_stamp") - days * MS_PER_DAY).scalar()
    return on_dates(points, floor).filter(F.col("time_stamp") >= floor)


# -- actions on a stored table -----------------------------------------------


def land(df: DataFrame, schema: T.StructType, path: str, name: str) -> None:
    """Adds rows to a stored table under the name of their append; again under that name replaces them.

    Every date has a folder for each append, and Spark's dynamic overwrite swaps in the folders written.
    No stored row is read or moved, and a call that failed half-way is mended by the same call.
    """
    spark, dates = df.sparkSession, partitions(df.sparkSession, path, PARTITION.name)
    if dates and not partitions(spark, f"{path.rstrip('/')}/{PARTITION.name}={dates[-1]}", BATCH.name):
        raise ValueError(f"{path} was not written by appends: load it into a new folder")
    dated = align(df, schema).withColumn(PARTITION.name, event_date("time_stamp")).withColumn(BATCH.name, F.lit(name))
    # One date may hold most rows: let Spark split large dates and merge small ones.
    _overwrite(dated.hint("rebalance", PARTITION.name), path)


def _overwrite(dated: DataFrame, path: str) -> None:
    """Replaces the folders of date and append that the rows belong to, and no other."""
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PARTITION.name, BATCH.name).parquet(path)


def _log(path: str) -> str:
    """Where the finished appends are noted; no reader of the table looks there."""
    return f"{path.rstrip('/')}/_log/appends"


def _note(spark: SparkSession, path: str, mark: int | None) -> None:
    entry = spark.range(1).select(F.lit(mark).cast("long").alias("time_stamp"))
    entry.coalesce(1).write.mode("append").parquet(_log(path))


def latest_time(spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """Latest time in a stored table, read from its latest date only."""
    for date in reversed(partitions(spark, path, PARTITION.name)):
        last = spark.read.schema(stored(schema)).parquet(path).filter(
            F.col(PARTITION.name) == F.lit(date).cast("date")
        )
        mark = high_water_mark(last).first()["time_stamp"]
        if mark is not None:
            return mark
    return None


def stored_mark(spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """The time up to which a stored table is whole: what a failed append left above it does not count.

    A table without a log was never appended to by night, and its latest time counts.
    """
    if not table_exists(spark, _log(path)):
        return latest_time(spark, path, schema)
    return high_water_mark(spark.read.schema(APPEND_LOG).parquet(_log(path))).first()["time_stamp"]


def settle(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Notes that all rows of a stored table are whole, if a night keeps a log there."""
    if table_exists(spark, _log(path)):
        _note(spark, path, latest_time(spark, path, schema))


def _append(df: DataFrame, schema: T.StructType, path: str, start: int | None = None) -> None:
    """Lands rows above a mark. Until that is noted as done, an append from the mark replaces them."""
    spark = df.sparkSession
    if not table_exists(spark, _log(path)):
        _note(spark, path, start)
    land(df, schema, path, "first" if start is None else f"after-{start}")
    settle(spark, path, schema)


def bootstrap(
    source: DataFrame, path: str, schema: T.StructType, today: dt.date, days: int = RETENTION_DAYS
) -> None:
    _append(bootstrap_window(source, today, days), schema, path)


def append_incremental(
    source: DataFrame, path: str, schema: T.StructType, today: dt.date | None = None, days: int = RETENTION_DAYS
) -> None:
    """Appends what is newer than the store; a store that holds nothing gets the window of a first night.

    That window ends before `today`, or else before the current date in UTC.
    """
    mark = stored_mark(source.sparkSession, path, schema)
    if mark is None:
        bootstrap(source, path, schema, today or dt.datetime.now(dt.timezone.utc).date(), days)
    else:
        _append(source.filter(F.col("time_stamp") > mark), schema, path, mark)


def retain(spark: SparkSession, path: str, schema: T.StructType, days: int = RETENTION_DAYS) -> None:
    """Trims a stored table: old dates are dropped as folders, only the boundary date is rewritten."""
    mark = latest_time(spark, path, schema)
    if mark is None:
        return
    floor = mark - days * MS_PER_DAY
    edge = dt.datetime.fromtimestamp(floor / 1000, dt.timezone.utc).date().isoformat()
    dates = partitions(spark, path, PARTITION.name)
    for date in (d for d in dates if d < edge):
        drop_partition(spark, path, PARTITION.name, date)
    if edge not in dates or floor == midnight_ms(dt.date.fromisoformat(edge)):
        return
    boundary = spark.read.schema(stored(schema)).parquet(path).filter(
        F.col(PARTITION.name) == F.lit(edge).cast("date")
    )
    kept = boundary.filter(F.col("time_stamp") >= floor)
    living = {r[0] for r in kept.select(BATCH.name).distinct().collect()}
    if not living:
        drop_partition(spark, path, PARTITION.name, edge)
        return
    _overwrite(kept, path)
    folder = f"{path.rstrip('/')}/{PARTITION.name}={edge}"
    for name in set(partitions(spark, folder, BATCH.name)) - living:
        drop_partition(spark, folder, BATCH.name, name)


def ingest(
    source: DataFrame,
    path: str,
    schema: T.StructType,
    today: dt.date,
    trim: bool,
    days: int = RETENTION_DAYS,
) -> str:
    """Bootstraps a new table, extends an existing one; measurements are trimmed, attributes never."""
    spark = source.sparkSession
    if stored_mark(spark, path, schema) is None:
        bootstrap(source, path, schema, today, days)
        return "bootstrap"
    append_incremental(source, path, schema)
    if trim:
        retain(spark, path, schema, days)
    return "incremental"
