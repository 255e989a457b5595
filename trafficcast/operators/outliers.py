"""Outlier rules of a series, evaluated per key.

A series has a far peak if max - median is at least twice its quantile q; then
values from twice the quantile on are outliers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _with_level(df: DataFrame, keys: Sequence[str], y: str, q: float) -> DataFrame:
    """Adds `_level`, NULL for a series without far peak.

    A series has at most one row per hour kept, so its exact quantiles are cheap.
    """
    per_key = Window.partitionBy(*keys)
    quantiles = F.percentile(y, F.array(F.lit(q), F.lit(0.5)))
    return (
        df.withColumns({"_q": quantiles.over(per_key), "_max": F.max(y).over(per_key)})
        .withColumn(
            "_level",
            F.when(F.col("_max") - F.col("_q")[1] >= 2 * F.col("_q")[0], 2 * F.col("_q")[0]),
        )
        .drop("_q", "_max")
    )


def null_outliers(df: DataFrame, keys: Sequence[str], y: str, out: str, q: float) -> DataFrame:
    """Adds `out`: y with outliers set to NULL."""
    kept = F.when(F.col(y) >= F.col("_level"), None).otherwise(F.col(y))
    return _with_level(df, keys, y, q).withColumn(out, kept).drop("_level")


def cap_outliers(df: DataFrame, keys: Sequence[str], y: str, out: str, q: float) -> DataFrame:
    """Adds `out`: y with outliers set to twice the quantile."""
    capped = F.when(F.col(y) >= F.col("_level"), F.col("_level")).otherwise(F.col(y))
    return _with_level(df, keys, y, q).withColumn(out, capped).drop("_level")
