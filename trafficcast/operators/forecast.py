"""Model frames, the additive forecast and the native trend forecast."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from trafficcast.constants import (
    DELAY_DAYS,
    DELAY_HOURS,
    HOURLY_TAIL,
    MIN_USABLE_POINTS,
    POINT_LIMIT,
)
from trafficcast.functions.additive import GAP, fit, predict
from trafficcast.operators.filters import enough_usable, long_enough
from trafficcast.operators.outliers import cap_outliers, null_outliers
from trafficcast.operators.series import placed


@dataclass(frozen=True)
class Horizon:
    """Grain of the model and how far it looks ahead."""

    name: str
    delay: int
    step: int  # seconds
    min_length: int

    def season(self, ds: Column) -> Column:
        return F.weekday(ds) if self.step == 86_400 else F.hour(ds)


DAYS = Horizon("30d", DELAY_DAYS, 86_400, POINT_LIMIT + 1)
HOURS = Horizon("48h", DELAY_HOURS, 3_600, HOURLY_TAIL)
HORIZONS = {h.name: h for h in (DAYS, HOURS)}

_RULES: dict[str, tuple[Callable, float]] = {
    "q75": (null_outliers, 0.75),
    "q50": (null_outliers, 0.50),
    "cap75": (cap_outliers, 0.75),
}


def holdout_split(series: DataFrame, keys: Sequence[str], delay: int, order: str = "ds") -> DataFrame:
    """Marks the last `delay` rows of each series as test rows."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return series.withColumn("is_test", F.row_number().over(newest) <= delay)


def model_frame(
    series: DataFrame,
    keys: Sequence[str],
    horizon: Horizon,
    outlier: str | None = None,
    min_usable: int = 0,
) -> DataFrame:
    """Gated series with what each fit may see: y_full for the forecast, y_train for validation.

    Takes keys..., ds, y. The outlier rule runs on the full series and on the
    training part separately; test rows stay as they are. All of it shares the
    one placement by key.
    """
    split = holdout_split(placed(series, keys), keys, horizon.delay).withColumn(
        "y_train", F.when(~F.col("is_test"), F.col("y"))
    )
    framed = long_enough(split, keys, horizon.min_length - 1)
    if outlier is None:
        framed = framed.withColumn("y_full", F.col("y"))
    else:
        rule, q = _RULES[outlier]
        framed = rule(framed, keys, "y", "y_full", q)
        framed = rule(framed, keys, "y_train", "y_train", q)
    if min_usable:
        framed = enough_usable(framed, keys, ["y_full", "y_train"], min_usable)
    return framed.select(*keys, "ds", "y", "y_full", "y_train", "is_test", "length")


# -- additive model ----------------------------------------------------------


def additive_fit(
    frame: DataFrame,
    keys: Sequence[str],
    horizon: Horizon,
    changepoint_scale: float,
    seasonality_scale: float,
    validate: bool = True,
    in_sample: bool = False,
) -> DataFrame:
    """Forecast and hold-out rows of every series: keys..., kind, ds, y, yhat, length, fit_seconds, gap, converged.

    One Arrow hand-off per series does both fits. A series is bounded by the
    hours kept in the store, however much traffic its key carries. Hold-out
    predictions cover the calendar steps after the training part; those that
    meet an observed test row become validation rows. `gap` is the larger relative
    duality gap of the two fits, and `converged` whether it is small enough. With
    `in_sample`, rows of kind `train` show what the validation fit says of its own points.
    """
    keys = list(keys)
    delay, step = horizon.delay, horizon.step
    key_fields = [f for f in frame.schema.fields if f.name in keys]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in key_fields]
        + [
            T.StructField("kind", T.StringType()),
            T.StructField("t", T.LongType()),
            T.StructField("y", T.DoubleType()),
            T.StructField("yhat", T.DoubleType()),
            T.StructField("length", T.LongType()),
            T.StructField("fit_seconds", T.DoubleType()),
            T.StructField("gap", T.DoubleType()),
        ]
    )
    names = [f.name for f in key_fields]

    def fit_series(group: pa.Table) -> pa.Table:
        started = time.perf_counter()
        t = group["t"].to_numpy()
        order = np.argsort(t)
        t = t[order]
        y, y_full, y_train = (group[c].to_numpy()[order] for c in ("y", "y_full", "y_train"))
        train = ~group["is_test"].to_numpy()[order]
        steps = step * np.arange(1, delay + 1)

        ahead = t[-1] + steps
        models = [fit(t, y_full, changepoint_scale, seasonality_scale)]
        parts = [("forecast", ahead, np.full(delay, np.nan), predict(models[0], ahead))]
        if validate:
            held = t[train][-1] + steps
            models.append(fit(t[train], y_train[train], changepoint_scale, seasonality_scale))
            yhat = predict(models[1], held)
            # Both ascend, so each held step finds its observed row, if there is one.
            seen, at_held, at_row = np.intersect1d(held, t, assume_unique=True, return_indices=True)
            actual, paired = y[at_row], yhat[at_held]
            known = ~np.isnan(actual)
            parts.append(("valid", seen[known], actual[known], paired[known]))
            if in_sample:
                learnt = ~np.isnan(y_train[train])
                at_train = t[train][learnt]
                parts.append(("train", at_train, y_train[train][learnt], predict(models[1], at_train)))

        kinds, times, actuals, predictions = zip(*parts)
        rows = sum(len(p) for p in times)
        constant = [group[name][0].as_py() for name in names]
        constant_fields = [group.schema.field(name).type for name in names]
        columns = [pa.repeat(pa.scalar(v, ty), rows) for v, ty in zip(constant, constant_fields)]
        columns += [
            pa.array(np.repeat(kinds, [len(p) for p in times])),
            pa.array(np.concatenate(times)),
            pa.array(np.concatenate(actuals), from_pandas=True),
            pa.array(np.concatenate(predictions)),
            pa.array(np.full(rows, len(t))),
            pa.array(np.full(rows, time.perf_counter() - started)),
            pa.array(np.full(rows, max(m.gap for m in models))),
        ]
        return pa.table(columns, names=schema.names)

    fitted = (
        placed(frame, keys)
        .withColumn("t", F.unix_timestamp("ds"))
        .select(*names, "t", "y", "y_full", "y_train", "is_test")
        .groupBy(*names)
        .applyInArrow(fit_series, schema)
    )
    return fitted.select(
        *names,
        "kind",
        F.timestamp_seconds("t").alias("ds"),
        "y",
        "yhat",
        "length",
        "fit_seconds",
        "gap",
        (F.col("gap") <= GAP).alias("converged"),
    )


_MODEL = (
    "last long, start double, span double, scale double, level double, slope double, knots array<double>,"
    " bends array<double>, waves array<struct<period: double, multiple: int, sine: double, cosine: double>>,"
    " gap double, converged boolean, length long, fit_seconds double"
)


def additive_models(
    frame: DataFrame,
    keys: Sequence[str],
    horizon: Horizon,
    changepoint_scale: float,
    seasonality_scale: float,
) -> DataFrame:
    """The fitted model of every series as one row, to be stored and scored any time.

    Columns: keys..., the last time seen (epoch seconds), the trend by its level, slope, knots and
    bends over (time - start) / span, the weights of all waves, the scale of it all, and how well
    the fit ended.
    """
    key_fields = [f for f in frame.schema.fields if f.name in keys]
    names = [f.name for f in key_fields]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in key_fields] + T.StructType.fromDDL(_MODEL).fields)

    def fit_series(group: pa.Table) -> pa.Table:
        started = time.perf_counter()
        group = group.sort_by("t")
        t = group["t"].to_numpy()
        model = fit(t, group["y_full"].to_numpy(), changepoint_scale, seasonality_scale)
        row = {name: group[name][0].as_py() for name in names} | {
            "last": int(t[-1]),
            **{c: getattr(model, c) for c in ("start", "span", "scale", "level", "slope", "gap", "converged")},
            "knots": model.knots.tolist(),
            "bends": model.bends.tolist(),
            "waves": [dict(zip(("period", "multiple", "sine", "cosine"), w, strict=True)) for w in model.waves],
            "length": len(t),
            "fit_seconds": time.perf_counter() - started,
        }
        fields = [group.schema.field(n) for n in names] + _MODEL_ARROW
        return pa.Table.from_pylist([row], pa.schema(fields))

    rows = placed(frame, keys).withColumn("t", F.unix_timestamp("ds")).select(*names, "t", "y_full")
    return rows.groupBy(*names).applyInArrow(fit_series, schema)


_WAVE = pa.struct([("period", pa.float64()), ("multiple", pa.int32()), ("sine", pa.float64()), ("cosine", pa.float64())])
_MODEL_ARROW = [
    pa.field("last", pa.int64()),
    *[pa.field(c, pa.float64()) for c in ("start", "span", "scale", "level", "slope")],
    pa.field("knots", pa.list_(pa.float64())),
    pa.field("bends", pa.list_(pa.float64())),
    pa.field("waves", pa.list_(_WAVE)),
    pa.field("gap", pa.float64()),
    pa.field("converged", pa.bool_()),
    pa.field("length", pa.int64()),
    pa.field("fit_seconds", pa.float64()),
]


def model_value(at: Column) -> Column:
    """What a stored model says for a time in epoch seconds; plain expressions on its row."""
    x = (at - F.col("start")) / F.col("span")
    bent = F.aggregate(
        F.arrays_zip("knots", "bends"),
        F.lit(0.0),
        lambda total, b: total + b["bends"] * F.greatest(x - b["knots"], F.lit(0.0)),
    )

    def wave(total: Column, w: Column) -> Column:
        angle = F.lit(2 * np.pi) * w["multiple"] * at / w["period"]
        return total + w["sine"] * F.sin(angle) + w["cosine"] * F.cos(angle)

    return F.col("scale") * (F.col("level") + F.col("slope") * x + bent + F.aggregate("waves", F.lit(0.0), wave))


def score_models(
    models: DataFrame, keys: Sequence[str], horizon: Horizon, after: dt.date | None = None, steps: int | None = None
) -> DataFrame:
    """Forecast rows keys..., ds, yhat of stored models, without a fit and without Python.

    Steps follow the last time each model saw, or the given date.
    """
    step, count = horizon.step, horizon.delay if steps is None else steps
    last = F.col("last") if after is None else F.unix_timestamp(F.lit(after).cast("timestamp"))
    at = F.explode(F.sequence(last + step, last + step * count, F.lit(step))).alias("_at")
    scored = models.select("*", at).withColumn("yhat", model_value(F.col("_at")))
    return scored.select(*keys, F.timestamp_seconds("_at").alias("ds"), "yhat")


def forecast_only(
    series: DataFrame,
    keys: Sequence[str],
    horizon: Horizon = DAYS,
    changepoint_scale: float = 0.1,
    seasonality_scale: float = 0.05,
) -> DataFrame:
    """Forecast from models of the full, capped series without validation, for every series at once.

    No length gate, but a fit needs enough usable points.
    """
    rule, q = _RULES["cap75"]
    frame = rule(placed(series, keys), keys, "y", "y_full", q)
    frame = enough_usable(frame, keys, ["y_full"], MIN_USABLE_POINTS)
    models = additive_models(frame, keys, horizon, changepoint_scale, seasonality_scale)
    return score_models(models, keys, horizon)


# -- native trend model ------------------------------------------------------


def future_calendar(last: DataFrame, last_column: str, horizon: Horizon) -> DataFrame:
    """`delay` steps after the last observed time of each row, without gaps."""
    step = F.make_dt_interval(secs=F.lit(float(horizon.step)))
    return last.withColumn(
        "ds",
        F.explode(
            F.sequence(
                F.col(last_column) + step,
                F.timestamp_seconds(
                    F.unix_timestamp(last_column) + F.lit(horizon.delay * horizon.step)
                ),
                step,
            )
        ),
    )


def trend_fitted(train: DataFrame, keys: Sequence[str], y: str, horizon: Horizon) -> DataFrame:
    """The same model at the rows it was fitted to: keys..., ds, y, yhat; rows without y go."""
    per_key = Window.partitionBy(*keys)
    x = (F.unix_timestamp("ds") - F.unix_timestamp(F.max("ds").over(per_key))) / F.lit(horizon.step)
    lined = (
        train.withColumn("_x", x.cast("long").cast("double"))
        .withColumn("_b", F.regr_slope(F.col(y), F.col("_x")).over(per_key))
        .withColumn("_line", F.regr_intercept(F.col(y), F.col("_x")).over(per_key) + F.col("_b") * F.col("_x"))
        .withColumn("_season", horizon.season(F.col("ds")))
    )
    effect = F.avg(F.col(y) - F.col("_line")).over(Window.partitionBy(*keys, "_season"))
    said = lined.withColumn("yhat", F.col("_line") + effect).filter(F.col(y).isNotNull())
    return said.select(*keys, "ds", F.col(y).alias("y"), "yhat")


def trend_forecast(train: DataFrame, keys: Sequence[str], y: str, horizon: Horizon) -> DataFrame:
    """Least-squares line plus the mean residual of each weekday or hour.

    Everything is an aggregate over rows placed by key: no join, no Python.
    The seasonal table of a key has at most 24 entries.
    """
    per_key = Window.partitionBy(*keys)
    x = (F.unix_timestamp("ds") - F.unix_timestamp("_t0")) / F.lit(horizon.step)
    lined = (
        train.withColumn("_t0", F.max("ds").over(per_key))
        .withColumn("_x", x.cast("long").cast("double"))
        .withColumn("_b", F.regr_slope(F.col(y), F.col("_x")).over(per_key))
        .withColumn("_a", F.regr_intercept(F.col(y), F.col("_x")).over(per_key))
    )
    seasonal = lined.groupBy(*keys, horizon.season(F.col("ds")).alias("_season")).agg(
        F.avg(F.col(y) - F.col("_a") - F.col("_b") * F.col("_x")).alias("_e"),
        *[F.first(c).alias(c) for c in ("_t0", "_a", "_b")],
    )
    fits = seasonal.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_season", "_e"))).alias("_effect"),
        *[F.first(c).alias(c) for c in ("_t0", "_a", "_b")],
    )
    steps = (F.unix_timestamp("ds") - F.unix_timestamp("_t0")) / F.lit(horizon.step)
    effect = F.coalesce(F.try_element_at("_effect", horizon.season(F.col("ds"))), F.lit(0.0))
    return (
        future_calendar(fits, "_t0", horizon)
        .withColumn("yhat", F.col("_a") + F.col("_b") * steps + effect)
        .select(*keys, "ds", "yhat")
    )
