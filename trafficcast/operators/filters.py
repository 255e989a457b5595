"""Row, key and series filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.constants import DEFAULT_APPS, MIN_USABLE_POINTS, POINT_LIMIT


def allow_apps(points: DataFrame, apps: Sequence[str] = DEFAULT_APPS) -> DataFrame:
    return points.filter(F.col("application").isin(*apps))


def nonzero_rows(points: DataFrame) -> DataFrame:
    """Measurements with a response time and bytes; NULLs go too."""
    return points.filter((F.col("app_rsp_time") != 0) & (F.col("byte_count") != 0))


def nonzero(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value) != 0)


def drop_denied(df: DataFrame, denylist: DataFrame, on: str = "source") -> DataFrame:
    """Rows whose source (or location) is not on the denylist.

    Spark broadcasts the list below its size threshold and joins by shuffle above it.
    """
    denied = denylist.select(on).filter(F.col(on).isNotNull()).distinct()
    return df.filter(F.col(on).isNotNull()).join(denied, on, "left_anti")


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A NULL key never selects a series."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def long_enough(series: DataFrame, keys: Sequence[str], limit: int = POINT_LIMIT) -> DataFrame:
    """Series with strictly more than `limit` points; adds their `length`."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return series.withColumn("length", n).filter(F.col("length") > limit)


def enough_usable(
    series: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    at_least: int = MIN_USABLE_POINTS,
) -> DataFrame:
    """Series with at least so many non-null points in each of the values."""
    per_key = Window.partitionBy(*keys)
    names = [f"_usable_{v}" for v in values]
    for name, value in zip(names, values):
        series = series.withColumn(name, F.count(value).over(per_key))
    for name in names:
        series = series.filter(F.col(name) >= at_least)
    return series.drop(*names)


def before(points: DataFrame, cut: Column | int) -> DataFrame:
    """The rows as of a time: strictly before the cut (epoch milliseconds)."""
    return points.filter(F.col("time_stamp") < cut)
