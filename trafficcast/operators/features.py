"""Lag features, shifted targets and scaling for the alternative models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.constants import HISTORY_LAG, MULTI_HORIZON, ROBUST_LOWER, ROBUST_UPPER


def lag_means(
    series: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    order: str = "date",
    lag: int = HISTORY_LAG,
) -> DataFrame:
    """Each feature becomes the mean of its preceding rows; the first rows keep their own value."""
    in_order = Window.partitionBy(*keys).orderBy(order)
    rn = F.row_number().over(in_order)
    preceding = in_order.rowsBetween(-lag, -1)
    return series.withColumns(
        {c: F.when(rn <= lag, F.col(c)).otherwise(F.avg(c).over(preceding)) for c in features}
    )


def horizon_targets(
    series: DataFrame,
    keys: Sequence[str],
    target: str,
    order: str = "date",
    horizons: int = MULTI_HORIZON,
) -> DataFrame:
    """One row per row and horizon h with the target h rows later; rows without one go."""
    in_order = Window.partitionBy(*keys).orderBy(order)
    ahead = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), F.lead(target, h).over(in_order).alias("target"))
            for h in range(1, horizons + 1)
        ]
    )
    return (
        series.withColumn("_ahead", ahead)
        .withColumn("_ahead", F.explode(F.filter("_ahead", lambda a: a["target"].isNotNull())))
        .select(*series.columns, "_ahead.horizon", "_ahead.target")
    )


def multi_targets(
    series: DataFrame,
    keys: Sequence[str],
    target: str,
    order: str = "date",
    horizons: int = MULTI_HORIZON,
) -> DataFrame:
    """Adds y1..yH, the next H values of the target; the last H rows of a series go."""
    in_order = Window.partitionBy(*keys).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    shifted = series.withColumns(
        {
            "_left": n - F.row_number().over(in_order),
            **{f"y{h}": F.lead(target, h).over(in_order) for h in range(1, horizons + 1)},
        }
    )
    return shifted.filter(F.col("_left") >= horizons).drop("_left")


def log_target(target: Column) -> Column:
    return F.ln(target)


def exp_prediction(prediction: Column) -> Column:
    return F.exp(prediction)


def _scaled(df, keys, columns, bounds, inverse):
    """(x - centre) / width per key; a zero width counts as 1."""
    per_key = Window.partitionBy(*keys)
    for c in columns:
        centre, width = bounds(c, per_key)
        df = df.withColumns({f"_{c}_centre": centre, f"_{c}_width": width})
    for c in columns:
        centre, width = F.col(f"_{c}_centre"), F.col(f"_{c}_width")
        width = F.when(width == 0, 1.0).otherwise(width)
        scaled = (F.col(c) - centre) / width
        df = df.withColumn(f"{c}_scaled", scaled)
        if inverse:
            df = df.withColumn(f"{c}_restored", F.col(f"{c}_scaled") * width + centre)
    return df.drop(*[f"_{c}_{part}" for c in columns for part in ("centre", "width")])


def minmax_scale(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    fit_on: Column | None = None,
    inverse: bool = False,
) -> DataFrame:
    """Columns scaled to [0, 1] per key by the range of the rows that `fit_on` selects."""

    def bounds(c, per_key):
        fitted = F.col(c) if fit_on is None else F.when(fit_on, F.col(c))
        low = F.min(fitted).over(per_key)
        return low, F.max(fitted).over(per_key) - low

    return _scaled(df, keys, columns, bounds, inverse)


def robust_scale(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    fit_on: Column | None = None,
    inverse: bool = False,
    lower: float = ROBUST_LOWER,
    upper: float = ROBUST_UPPER,
) -> DataFrame:
    """Columns centred on their median and divided by a percentile range, per key."""

    def bounds(c, per_key):
        fitted = F.col(c) if fit_on is None else F.when(fit_on, F.col(c))
        low, mid, high = (F.percentile(fitted, F.lit(q)).over(per_key) for q in (lower, 0.5, upper))
        return mid, high - low

    return _scaled(df, keys, columns, bounds, inverse)
