"""Boosted-tree forecast: direct multi-horizon on lag features.

Every series has a booster of its own for each horizon. A series reaches Python once, as one Arrow
group that is bounded by the days kept, and all its horizons are fitted together on shared bins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.constants import (
    BOOST_DEPTH,
    BOOST_ETA,
    BOOST_MIN_CHILD,
    BOOST_ROUNDS,
    FEATURE_MEASURES,
    MULTI_HORIZON,
    POINT_LIMIT,
)
from trafficcast.functions.boosting import boosted_trees
from trafficcast.operators.features import exp_prediction, lag_means, log_target
from trafficcast.operators.filters import long_enough
from trafficcast.operators.series import placed


def boosted_frame(daily: DataFrame, keys: Sequence[str], target: str = FEATURE_MEASURES[0]) -> DataFrame:
    """Gated series with lag features, weekday, target and its logarithm."""
    measures = [m for m in FEATURE_MEASURES if m != target]
    gated = long_enough(placed(daily, keys), keys, POINT_LIMIT)
    lagged = lag_means(gated, keys, measures)
    return lagged.select(*keys, "date", *measures, "weekday", target, log_target(F.col(target)).alias("label"))


def boosted_holdout(
    daily: DataFrame,
    keys: Sequence[str],
    target: str = FEATURE_MEASURES[0],
    horizons: int = MULTI_HORIZON,
    rounds: int = BOOST_ROUNDS,
) -> DataFrame:
    """keys..., origin, horizon, ds, y, yhat, split: what the boosters say of rows seen and held out.

    The last `horizons` days of a series are held out. A booster learns from days whose target lies
    before them (split `train`, in sample); asked on the last of those days, it looks into the held-out
    part (split `test`). A horizon counts rows of the series.
    """
    keys = list(keys)
    frame = boosted_frame(daily, keys, target)
    key_fields = [f for f in frame.schema.fields if f.name in keys]
    names = [f.name for f in key_fields]
    tail = "origin date, horizon int, ds date, y double, label double, split string"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in key_fields] + T.StructType.fromDDL(tail).fields)
    inputs = [c for c in frame.columns if c not in {*keys, "date", target, "label"}]

    def fit_series(group: pa.Table) -> pa.Table:
        group = group.sort_by("date")
        n, ahead = group.num_rows, np.arange(1, horizons + 1)
        x = np.column_stack([group[c].cast(pa.float64()).to_numpy() for c in inputs])
        label = group["label"].to_numpy()
        last = n - horizons - 1
        reach = np.arange(n)[:, None] + ahead
        seen = reach <= last
        targets = np.where(seen, label[np.minimum(reach, n - 1)], np.nan)[: last + 1]
        fitted, beyond = boosted_trees(
            x[: last + 1], targets, x[last : last + 1], rounds, BOOST_DEPTH, BOOST_ETA, BOOST_MIN_CHILD
        )
        row, h = np.nonzero(~np.isnan(targets))
        origin = np.concatenate([row, np.full(horizons, last)])
        horizon = np.concatenate([ahead[h], ahead])
        said = np.concatenate([fitted[row, h], beyond[0]])
        lands = pa.array(origin + horizon)
        columns = [pa.repeat(pa.scalar(group[k][0].as_py(), group.schema.field(k).type), len(origin)) for k in names]
        columns += [
            group["date"].take(pa.array(origin)).combine_chunks(),
            pa.array(horizon, pa.int32()),
            group["date"].take(lands).combine_chunks(),
            group[target].take(lands).combine_chunks().cast(pa.float64()),
            pa.array(said, from_pandas=True),
            pa.array(["train"] * len(row) + ["test"] * horizons),
        ]
        return pa.table(columns, names=schema.names)

    said = frame.groupBy(*names).applyInArrow(fit_series, schema)
    return said.select(*names, "origin", "horizon", "ds", "y", exp_prediction(F.col("label")).alias("yhat"), "split")


def boosted_forecast(
    daily: DataFrame,
    keys: Sequence[str],
    target: str = FEATURE_MEASURES[0],
    horizons: int = MULTI_HORIZON,
    rounds: int = BOOST_ROUNDS,
) -> DataFrame:
    """Hold-out predictions: keys..., horizon, y, yhat."""
    rows = boosted_holdout(daily, keys, target, horizons, rounds).filter(F.col("split") == "test")
    return rows.select(*keys, "horizon", "y", "yhat")
