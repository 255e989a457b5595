"""One hold-out frame for several models of the same series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.constants import BOOST_ROUNDS, FEATURE_MEASURES
from trafficcast.operators.boosted import boosted_holdout
from trafficcast.operators.evaluate import error_metrics, pair, with_errors
from trafficcast.operators.forecast import DAYS, Horizon, additive_fit, model_frame, trend_fitted, trend_forecast
from trafficcast.session import staged

MODELS = ("trend", "additive", "boosted")


def trend_holdout(frame: DataFrame, keys: Sequence[str], horizon: Horizon) -> DataFrame:
    """keys..., ds, y, yhat, split of the trend model: held-out rows, and those its fit has seen."""
    train = frame.filter(~F.col("is_test"))
    ahead = trend_forecast(train, keys, "y_train", horizon)
    test = pair(frame.filter("is_test").select(*keys, "ds", "y"), ahead, keys)
    seen = trend_fitted(train.drop("y"), keys, "y_train", horizon)
    tagged = [(test, "test"), (seen, "train")]
    return reduce(DataFrame.unionByName, [df.select(*keys, "ds", "y", "yhat", F.lit(s).alias("split")) for df, s in tagged])


def additive_holdout(
    frame: DataFrame, keys: Sequence[str], horizon: Horizon, changepoint_scale: float, seasonality_scale: float
) -> DataFrame:
    """The same of the additive model; both splits come from one fit."""
    fitted = additive_fit(frame, keys, horizon, changepoint_scale, seasonality_scale, in_sample=True)
    split = F.when(F.col("kind") == "valid", "test").when(F.col("kind") == "train", "train")
    return fitted.withColumn("split", split).filter("split IS NOT NULL").select(*keys, "ds", "y", "yhat", "split")


def holdout(
    daily: DataFrame,
    keys: Sequence[str],
    target: str = FEATURE_MEASURES[0],
    scales: tuple[float, float] = (0.1, 0.05),
    rounds: int = BOOST_ROUNDS,
) -> DataFrame:
    """model, keys..., ds, y, yhat, split of trend, additive and boosted models of daily measures.

    All models see the same series without their last 30 days (split `train`, in sample) and are asked
    about those (split `test`). Boosters answer once per horizon, so a day they have seen has several
    rows.
    """
    keys = list(keys)
    series = daily.select(*keys, F.col("date").cast("timestamp").alias("ds"), F.col(target).cast("double").alias("y"))
    frame = model_frame(series, keys, DAYS)
    trees = boosted_holdout(daily, keys, target, rounds=rounds)
    parts = (
        trend_holdout(frame, keys, DAYS),
        additive_holdout(frame, keys, DAYS, *scales),
        trees.select(*keys, F.col("ds").cast("timestamp").alias("ds"), "y", "yhat", "split"),
    )
    tagged = [df.select(F.lit(model).alias("model"), *keys, "ds", "y", "yhat", "split") for model, df in zip(MODELS, parts, strict=True)]
    return reduce(DataFrame.unionByName, tagged)


def holdout_scores(rows: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Test scores of each model, as `compare_models` takes them; the rows are written first."""
    kept = staged(rows.filter(F.col("split") == "test"), "holdout")
    models = [r.model for r in kept.select("model").distinct().collect()]
    scored = error_metrics(with_errors(kept), ["model", *keys])
    return {m: scored.filter(F.col("model") == m).drop("model") for m in sorted(models)}
