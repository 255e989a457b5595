"""Validation pairs and error metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.functions.columns import ape


def pair(actual: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual rows with the prediction for the same time; unmatched rows go."""
    joined = actual.join(predicted.select(*keys, "ds", "yhat"), [*keys, "ds"])
    return joined.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull())


def with_errors(paired: DataFrame) -> DataFrame:
    error = F.col("y") - F.col("yhat")
    return paired.withColumn("error_test", error).withColumn(
        "APE", ape(F.col("y"), F.col("error_test"))
    )


def error_metrics(valid: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAPE and its spread per key; `carry` names columns constant per key.

    The mean below the 98th percentile is strict, so it is NULL if all errors are equal.
    A key has at most one row per step held out, so exact percentiles are cheap.
    """
    p98 = F.percentile("APE", F.lit(0.98)).over(Window.partitionBy(*keys))
    e, a = F.col("error_test"), F.col("APE")
    return (
        valid.withColumn("_p98", p98)
        .groupBy(*keys)
        .agg(
            *[F.first(c).alias(c) for c in carry],
            F.sqrt(F.avg(e * e)).alias("test_rmse"),
            F.avg(a).alias("test_mape"),
            F.stddev_pop(a).alias("std_mape"),
            (F.min(a) / 100).alias("min_error_rate"),
            (F.max(a) / 100).alias("max_error_rate"),
            (F.percentile(a, F.lit(0.5)) / 100).alias("median_error_rate"),
            F.avg(F.when(a < F.col("_p98"), a)).alias("test_mape_98"),
        )
    )


def split_scores(paired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Train and test scores of a model from pairs tagged with `split`, to two decimals."""
    scored = error_metrics(with_errors(paired), [*keys, "split"])
    return scored.select(
        *keys,
        "split",
        F.round("test_rmse", 2).alias("rmse"),
        F.round("test_mape", 2).alias("mape"),
        F.round("test_mape_98", 2).alias("mape_98"),
    )
