"""Summaries and correlations of measurements and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.functions.quantiles import exact_quantiles


def _melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keys), list(columns), name, "value")


def summary(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max of each column, per key or overall.

    Quartiles are exact, and no group has to fit into one task.
    """
    keys = list(keys)
    long = _melt(df, keys, columns, "column").filter(F.col("value").isNotNull())
    moments = long.groupBy(*keys, "column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = (
        exact_quantiles(long, [*keys, "column"], "value", list(probs.values()))
        .groupBy(*keys, "column")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in probs.items()])
    )
    return moments.join(quartiles, [*keys, "column"]).select(
        *keys, "column", "count", "mean", "std", "min", *probs, "max"
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one aggregation.

    Rows: column_a, column_b, corr; both orders and the diagonal are present.
    """
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = typed.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        cells += [
            F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"{a}|{b}").alias("corr"))
            for x, y in {(a, b), (b, a)}
        ]
    return one.select(F.inline(F.array(*cells)))


def hour_means(points: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per hour, of one key or of each."""
    return points.groupBy(*keys, "time_stamp").agg(*[F.avg(c).alias(c) for c in columns])
