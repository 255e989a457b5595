"""What charts and monitoring read from the result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.plans.reports import ReportSpec

METRICS = ("test_mape", "test_rmse", "total_run_time")
ALL_KEYS = ("application", "source", "location")


def monitoring(analyses: Mapping[str, DataFrame], metrics: Sequence[str] = METRICS) -> DataFrame:
    """report, keys, run_date, metric, value over the analysis history of every report.

    Keys a report does not have are NULL.
    """

    def one(name: str, table: DataFrame) -> DataFrame:
        keys = [
            (F.col(k) if k in table.columns else F.lit(None).cast("string")).alias(k)
            for k in ALL_KEYS
        ]
        values = [F.col(m).cast("double").alias(m) for m in metrics]
        return table.select(F.lit(name).alias("report"), *keys, "run_date", *values).unpivot(
            ["report", *ALL_KEYS, "run_date"], list(metrics), "metric", "value"
        )

    return reduce(DataFrame.unionByName, [one(n, t) for n, t in analyses.items()])


def last_dates(data: DataFrame, keys: Sequence[str], n: int, date: str = "date") -> DataFrame:
    """Rows on the last n distinct dates of each key."""
    newest = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    return (
        data.withColumn("_rank", F.dense_rank().over(newest)).filter(F.col("_rank") <= n).drop("_rank")
    )


def latest_scores(analysis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RMSE and MAPE of each key's latest run, to two decimals."""
    return analysis.groupBy(*keys).agg(
        F.max("run_date").alias("run_date"),
        F.round(F.max_by("test_rmse", "run_date"), 2).alias("rmse"),
        F.round(F.max_by("test_mape", "run_date"), 2).alias("mape"),
    )


def _line(df: DataFrame, keys: Sequence[str], kind: str, ds: str, value: str) -> DataFrame:
    return df.select(
        *keys,
        F.lit(kind).alias("kind"),
        F.col(ds).cast("timestamp").alias("ds"),
        F.col(value).cast("double").alias("value"),
    )


def evaluation_chart(
    data: DataFrame, valid: DataFrame, analysis: DataFrame, spec: ReportSpec, n: int = 1
) -> DataFrame:
    """History before the hold-out, actual and predicted values, with the key's latest scores."""
    keys = list(spec.keys)
    starts = valid.groupBy(*keys).agg(F.min("ds").alias("_start"))
    earlier = data.join(starts, keys).filter(F.col("date").cast("timestamp") < F.col("_start"))
    lines = [
        _line(last_dates(earlier, keys, n), keys, "train_data", "date", spec.value),
        _line(valid, keys, "actual", "ds", "y"),
        _line(valid, keys, "predicted", "ds", "yhat"),
    ]
    scores = latest_scores(analysis, keys).drop("run_date")
    return reduce(DataFrame.unionByName, lines).join(scores, keys, "left")


def user_chart(data: DataFrame, forecast: DataFrame, spec: ReportSpec, n: int = 1) -> DataFrame:
    """The last dates of history and the forecast."""
    keys = list(spec.keys)
    history = _line(last_dates(data, keys, n), keys, "train_data", "date", spec.value)
    return history.unionByName(_line(forecast, keys, "forecast", "ds", "yhat"))
