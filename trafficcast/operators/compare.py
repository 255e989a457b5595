"""Comparison of several models by their scores per series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.operators.explore import summary


def model_scores(scores: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Scores of all models under one another: model, keys..., test_mape."""
    tagged = [
        df.select(F.lit(model).alias("model"), *keys, "test_mape") for model, df in scores.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def compare_models(scores: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per series with `<model>_mape` of every model."""
    long = model_scores(scores, keys)
    wide = long.groupBy(*keys).pivot("model", list(scores)).agg(F.first("test_mape"))
    return wide.select(*keys, *[F.col(m).alias(f"{m}_mape") for m in scores])


def score_summary(scores: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Count, mean, spread and quartiles (so the median) of the scores of each model.

    A model has one score per series, so its group is as large as the set of series.
    """
    return summary(model_scores(scores, keys), ["model"], ["test_mape"])


def model_run_time(fitted: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Minutes each model spent on all series, and on how many, from frames with `fit_seconds` per series."""
    tagged = [
        df.groupBy(*keys)
        .agg(F.first("fit_seconds").alias("fit_seconds"))
        .groupBy()
        .agg(
            F.round(F.coalesce(F.sum("fit_seconds"), F.lit(0.0)) / 60, 8).alias("run_time"),
            F.count(F.when(F.col("fit_seconds") > 0, 1)).alias("series"),
        )
        .select(F.lit(model).alias("model"), "run_time", "series")
        for model, df in fitted.items()
    ]
    return reduce(DataFrame.unionByName, tagged)
