"""Queries over forecasts, evaluation, features and model comparison."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.constants import BOOST_ETA, BOOST_ROUNDS, FEATURE_MEASURES, MULTI_HORIZON
from trafficcast.functions.columns import event_time, weekday
from trafficcast.operators import features as X
from trafficcast.operators.boosted import boosted_forecast
from trafficcast.operators.compare import compare_models, model_run_time, score_summary
from trafficcast.operators.evaluate import error_metrics, split_scores, with_errors
from trafficcast.operators.filters import allow_apps, enough_usable
from trafficcast.operators.forecast import (
    DAYS,
    HORIZONS,
    HOURS,
    additive_fit,
    additive_models,
    forecast_only,
    holdout_split,
    model_frame,
    score_models,
)
from trafficcast.operators.series import daily_peak_measures, hourly_measures
from trafficcast.plans.holdout import holdout, holdout_scores, trend_holdout
from trafficcast.plans.reports import (
    REPORTS,
    analysis_table,
    as_series,
    data_table,
    fit,
    forecast_table,
    valid_table,
)
from trafficcast.plans.trend import trend_tables
from trafficcast.registry.core import query
from trafficcast.registry.series import (
    MEASURE_DAYS,
    MEASURE_HOURS,
    daily_measures_of,
    data_of,
    measures_of,
    series_of,
)
from trafficcast.registry.sql import (
    EVENTS,
    KEYS,
    ORDERS,
    POINTS,
    SEASON,
    analysis,
    data as data_sql,
    describe,
    metrics,
    trend_chain,
)
from trafficcast.session import staged
from trafficcast.sources.adapters import ORDER_APPS, event_points, order_points

RUN_DATE = {"48h": dt.date(2024, 1, 31), "30d": dt.date(2001, 11, 5)}
_BOTH = ["application", "source"]
_METRIC_KINDS = (
    "test_rmse:d test_mape:d std_mape:d min_error_rate:d max_error_rate:d"
    " median_error_rate:d test_mape_98:d"
)


def trend_of(spark, folder, report, horizon, outlier=None):
    data = data_of(spark, folder, report, horizon)
    return trend_tables(data, REPORTS[report], horizon, RUN_DATE[horizon], outlier)


# -- native trend model ------------------------------------------------------


def _kinds(report):
    return "".join(f"{k}:s " for k in KEYS[report])


def _trend_query(name, table, report, horizon, digits=6):
    keys = ", ".join(KEYS[report])
    chain = f"WITH {POINTS[horizon]}, {trend_chain(report, horizon)} "
    body, kinds = {
        "forecast": (f"SELECT {keys}, ds, yhat FROM ahead", "ds:t yhat:d"),
        "valid": ("SELECT * FROM valid", "ds:t y:d yhat:d error_test:d APE:d"),
        "analyse": (analysis(report), f"{_METRIC_KINDS} length:i"),
    }[table]

    @query(name, chain + body, _kinds(report) + kinds, digits)
    def run(spark, folder):
        return trend_of(spark, folder, report, horizon)[table].drop("run_date")


_trend_query("trend_forecast_daily", "forecast", "p9", "30d")
_trend_query("trend_forecast_hourly", "forecast", "p9", "48h")
_trend_query("trend_validation", "valid", "p9", "48h")
_trend_query("trend_validation_daily", "valid", "p1", "30d")
for _report in REPORTS:
    for _horizon in HORIZONS:
        _trend_query(f"trend_analysis_{_report}_{_horizon}", "analyse", _report, _horizon)


@query(
    "error_metrics",
    f"WITH {EVENTS}, {trend_chain('p10', '48h')} {metrics('valid', 'application, source')}",
    f"application:s source:s {_METRIC_KINDS}",
    digits=6,
)
def metrics_query(spark, folder):
    return error_metrics(trend_of(spark, folder, "p10", "48h")["valid"], _BOTH)


@query(
    "split_scores",
    f"WITH {EVENTS}, {trend_chain('p9', '48h')},"
    " seen AS (SELECT source, ds, y, a + b * x + e AS yhat FROM held_x JOIN held_fit USING (source)"
    f" JOIN held_eff USING (source) WHERE season = {SEASON['48h'].format('ds')} AND y IS NOT NULL),"
    " pairs AS (SELECT source, y - yhat AS error_test, abs((y - yhat) * 100 / nullif(y, 0)) AS \"APE\", 'train' AS split FROM seen"
    " UNION ALL SELECT source, error_test, \"APE\", 'test' AS split FROM valid)"
    " SELECT source, split, round(test_rmse, 2) AS rmse, round(test_mape, 2) AS mape,"
    f" round(test_mape_98, 2) AS mape_98 FROM ({metrics('pairs', 'source, split')})",
    "source:s split:s rmse:d mape:d mape_98:d",
    digits=6,
)
def scores_by_split(spark, folder):
    """Scores of one fit, at the points it has seen and at those held out."""
    spec = REPORTS["p9"]
    frame = model_frame(series_of(spark, folder, "p9", "48h"), ["source"], HOURS, spec.outlier, spec.min_usable)
    return split_scores(trend_holdout(frame, ["source"], HOURS), ["source"])


# -- additive model: fitted in Python, so without SQL ------------------------


_WEEKDAYS = (0, 1, 3, -2, 5, 2, -4)


def curve_sql(season, ds="ds"):
    """A line, with a weekday or hour effect, as SQL."""
    line = f"100.00012 + 0.01 * (epoch(CAST({ds} AS TIMESTAMP)) / 86400 - 10000)"
    waves = {
        None: "0",
        "hour": f"5 * sin(2 * pi() * hour(CAST({ds} AS TIMESTAMP)) / 24)",
        "weekday": f"list_extract({list(_WEEKDAYS)}, CAST(isodow(CAST({ds} AS TIMESTAMP)) AS INTEGER))",
    }
    return f"{line} + {waves[season]}"


def on_curve(data, value, season):
    """A data table with that curve in place of its values."""
    ds = F.col("date").cast("timestamp")
    line = 100.00012 + 0.01 * (F.unix_timestamp(ds) / 86400 - 10000)
    waves = {
        None: F.lit(0),
        "hour": 5 * F.sin(2 * np.pi * F.hour(ds) / 24),
        "weekday": F.array(*map(F.lit, _WEEKDAYS))[F.weekday(ds)],
    }
    return data.withColumn(value, line + waves[season])


def _additive_queries(report, horizon):
    spec, grain, date = REPORTS[report], HORIZONS[horizon], RUN_DATE[horizon]
    keys = ", ".join(KEYS[report])

    def fitted(spark, folder):
        return fit(data_of(spark, folder, report, horizon), spec, grain)

    @query(f"additive_forecast_{report}_{horizon}", digits=4)
    def forecast(spark, folder):
        return forecast_table(fitted(spark, folder), spec, date)

    @query(f"additive_validation_{report}_{horizon}", digits=4)
    def validation(spark, folder):
        return valid_table(fitted(spark, folder), spec)

    @query(f"additive_analysis_{report}_{horizon}", digits=4)
    def analysed(spark, folder):
        return analysis_table(fitted(spark, folder), spec, date)

    # All but the fitted numbers has SQL: gate, calendar and the pairing with actual values.
    @query(
        f"additive_steps_{report}_{horizon}",
        f"WITH {POINTS[horizon]}, {trend_chain(report, horizon)}"
        f" SELECT {keys}, 'forecast' AS kind, ds, CAST(NULL AS DOUBLE) AS y, true AS fitted, true AS converged FROM ahead"
        f" UNION ALL SELECT {keys}, 'valid' AS kind, ds, y, true AS fitted, true AS converged FROM valid",
        f"{_kinds(report)}kind:s ds:t y:d fitted:s converged:s",
    )
    def steps(spark, folder):
        rows = fitted(spark, folder)
        return rows.select(*spec.keys, "kind", "ds", "y", (~F.isnan("yhat")).alias("fitted"), "converged")

    # Values that the model can say exactly, at the keys and times of the table: it must find them.
    # The training part of 90 hours in a row is shorter than the two days that a daily season needs.
    curves = {"forecast": "hour", "valid": None} if horizon == "48h" else dict.fromkeys(("forecast", "valid"), "weekday")

    @query(
        f"additive_recovers_{report}_{horizon}",
        f"WITH {POINTS[horizon]}, {trend_chain(report, horizon)} "
        + " UNION ALL ".join(
            f"SELECT {keys}, '{kind}' AS kind, ds, {curve_sql(season)} AS yhat, true AS converged FROM {table}"
            for (kind, season), table in zip(curves.items(), ("ahead", "valid"), strict=True)
        ),
        f"{_kinds(report)}kind:s ds:t yhat:d converged:s",
        digits=3,
    )
    def recovers(spark, folder):
        data, parts = data_of(spark, folder, report, horizon), []
        for kind, season in curves.items():
            rows = fit(on_curve(data, spec.value, season), spec, grain)
            parts.append(rows.filter(F.col("kind") == kind).select(*spec.keys, "kind", "ds", "yhat", "converged"))
        return parts[0].unionByName(parts[1])


for _report in REPORTS:
    for _horizon in HORIZONS:
        _additive_queries(_report, _horizon)


@query("forecast_only", digits=4)
def forecast_alone(spark, folder):
    return forecast_only(series_of(spark, folder, "p1", "30d"), _BOTH, DAYS)


# Every series with at least ten points is modelled, however short.
_UNGATED = (
    f"WITH {ORDERS}, data AS ({data_sql('p1', '30d')}), last AS (SELECT application, source,"
    " CAST(max(date) AS TIMESTAMP) AS t0 FROM data GROUP BY application, source HAVING count(*) >= 10),"
    " ahead AS (SELECT application, source, t0 + to_days(CAST(h AS INTEGER)) AS ds FROM last, range(1, 31) AS r(h))"
)


@query(
    "stored_models_recover",
    f"{_UNGATED} SELECT application, source, ds, {curve_sql('weekday')} AS yhat FROM ahead",
    "application:s source:s ds:t yhat:d",
    digits=3,
)
def stored_models_recover(spark, folder):
    """Forecast of written models, read back: no series is fitted when it is asked."""
    data = on_curve(data_of(spark, folder, "p1", "30d"), "app_rsp_time", "weekday")
    frame = enough_usable(as_series(data, REPORTS["p1"]).withColumn("y_full", F.col("y")), _BOTH, ["y_full"])
    models = staged(additive_models(frame, _BOTH, DAYS, 0.1, 0.05), "models")
    return score_models(models, _BOTH, DAYS)


@query(
    "stored_models_match_fit",
    f"WITH {ORDERS}, {trend_chain('p1', '30d')} SELECT application, source, count(*) AS steps, count(*) AS equal"
    " FROM ahead GROUP BY application, source",
    "application:s source:s steps:i equal:i",
)
def stored_models_match_fit(spark, folder):
    """Steps of each series, and those at which the stored model says what the fit said."""
    spec = REPORTS["p1"]
    frame = model_frame(series_of(spark, folder, "p1", "30d"), _BOTH, DAYS, spec.outlier, spec.min_usable)
    models = staged(additive_models(frame, _BOTH, DAYS, *spec.scales["30d"]), "models")
    fitted = additive_fit(frame, _BOTH, DAYS, *spec.scales["30d"]).filter(F.col("kind") == "forecast")
    both = fitted.join(score_models(models, _BOTH, DAYS).withColumnRenamed("yhat", "scored"), [*_BOTH, "ds"], "left")
    near = F.abs(F.col("yhat") - F.col("scored")) <= 1e-9 * F.greatest(F.abs("yhat"), F.lit(1.0))
    return both.groupBy(*_BOTH).agg(F.count("*").alias("steps"), F.count(F.when(near, 1)).alias("equal"))


# -- features ----------------------------------------------------------------

_LAGGED = [m for m in FEATURE_MEASURES if m != "app_rsp_time"]
_OVER = "OVER (PARTITION BY application, source ORDER BY date"


@query(
    "lag_mean_features",
    f"WITH {ORDERS}, days AS ({MEASURE_DAYS}) SELECT application, source, date, app_rsp_time, "
    + ", ".join(
        f"CASE WHEN row_number() {_OVER}) <= 5 THEN {m}"
        f" ELSE avg({m}) {_OVER} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END AS {m}"
        for m in _LAGGED
    )
    + ", weekday FROM days",
    "application:s source:s date:t app_rsp_time:d " + " ".join(f"{m}:d" for m in _LAGGED) + " weekday:i",
    digits=7,
)
def lag_mean_features(spark, folder):
    return X.lag_means(daily_measures_of(spark, folder), _BOTH, _LAGGED)


@query(
    "horizon_targets",
    f"WITH {EVENTS}, days AS ({MEASURE_DAYS}), numbered AS"
    f" (SELECT application, source, date, app_rsp_time, row_number() {_OVER}) AS rn FROM days)"
    " SELECT n.application, n.source, n.date, later.rn - n.rn AS horizon, later.app_rsp_time AS target"
    " FROM numbered AS n JOIN numbered AS later ON n.application = later.application"
    f" AND n.source = later.source AND later.rn BETWEEN n.rn + 1 AND n.rn + {MULTI_HORIZON}",
    "application:s source:s date:t horizon:i target:d",
)
def horizon_targets(spark, folder):
    days = daily_peak_measures(hourly_measures(event_points(spark, folder), _BOTH), _BOTH)
    shifted = X.horizon_targets(days, _BOTH, "app_rsp_time")
    return shifted.select(*_BOTH, "date", "horizon", "target")


_TARGETS = range(1, MULTI_HORIZON + 1)


@query(
    "multi_output_targets",
    f"WITH {ORDERS}, days AS ({MEASURE_DAYS}) SELECT application, source, date, "
    + ", ".join(f"lead(app_rsp_time, {h}) {_OVER}) AS y{h}" for h in _TARGETS)
    + f" FROM days QUALIFY count(*) OVER (PARTITION BY application, source) - row_number() {_OVER}) >= {MULTI_HORIZON}",
    "application:s source:s date:t " + " ".join(f"y{h}:d" for h in _TARGETS),
)
def multi_output_targets(spark, folder):
    shifted = X.multi_targets(daily_measures_of(spark, folder), _BOTH, "app_rsp_time")
    return shifted.select(*_BOTH, "date", *[f"y{h}" for h in _TARGETS])


_SPLIT_DAYS = (
    f"WITH {ORDERS}, days AS (SELECT *, row_number() {_OVER} DESC) > {MULTI_HORIZON} AS fitted FROM ({MEASURE_DAYS})),"
)
_SCALED_KINDS = "application:s source:s date:t byte_count_scaled:d byte_count_restored:d flow_count_scaled:d flow_count_restored:d"


def _scale_sql(stats, centre, width):
    columns = ", ".join(
        f"({c} - {centre.format(c)}) / {width.format(c)} AS {c}_scaled, {c} AS {c}_restored"
        for c in ("byte_count", "flow_count")
    )
    by_column = ", ".join(stats.format(c) for c in ("byte_count", "flow_count"))
    return (
        f"{_SPLIT_DAYS} stats AS (SELECT application, source, {by_column} FROM days WHERE fitted"
        f" GROUP BY application, source) SELECT application, source, date, {columns}"
        " FROM days JOIN stats USING (application, source)"
    )


def _scale_query(name, scale, body):
    @query(name, body, _SCALED_KINDS, digits=8)
    def run(spark, folder):
        days = holdout_split(daily_measures_of(spark, folder), _BOTH, MULTI_HORIZON, "date")
        columns = ["byte_count", "flow_count"]
        scaled = scale(days, _BOTH, columns, fit_on=~F.col("is_test"), inverse=True)
        shown = [f"{c}_{part}" for c in columns for part in ("scaled", "restored")]
        return scaled.select(*_BOTH, "date", *shown)


_scale_query(
    "minmax_scale",
    X.minmax_scale,
    _scale_sql("min({0}) AS {0}_lo, max({0}) AS {0}_hi", "{0}_lo", "({0}_hi - {0}_lo)"),
)
_scale_query(
    "robust_scale",
    X.robust_scale,
    _scale_sql(
        "quantile_cont({0}, 0.05) AS {0}_lo, quantile_cont({0}, 0.5) AS {0}_mid, quantile_cont({0}, 0.95) AS {0}_hi",
        "{0}_mid",
        "({0}_hi - {0}_lo)",
    ),
)


@query(
    "calendar_features",
    f"WITH {ORDERS} SELECT application, source, time_stamp, isodow(epoch_ms(time_stamp)) - 1 AS weekday,"
    f" hour(epoch_ms(time_stamp)) AS hour FROM ({MEASURE_HOURS})",
    "application:s source:s time_stamp:i weekday:i hour:i",
)
def calendar_features(spark, folder):
    ts = event_time("time_stamp")
    return measures_of(spark, folder).select(
        *_BOTH, "time_stamp", weekday(ts).alias("weekday"), F.hour(ts).alias("hour")
    )


@query(
    "log_target",
    f"WITH {ORDERS} SELECT application, source, date, ln(app_rsp_time) AS log_target,"
    f" exp(ln(app_rsp_time)) AS restored FROM ({MEASURE_DAYS})",
    "application:s source:s date:t log_target:d restored:d",
)
def log_target(spark, folder):
    logged = X.log_target(F.col("app_rsp_time"))
    return daily_measures_of(spark, folder).select(
        *_BOTH, "date", logged.alias("log_target"), X.exp_prediction(logged).alias("restored")
    )


# -- boosted trees and comparison --------------------------------------------


def _model_days(spark, folder):
    points = allow_apps(order_points(spark, folder), ORDER_APPS)
    return daily_peak_measures(hourly_measures(points, _BOTH), _BOTH)


@query("boosted_forecast", digits=4)
def boosted(spark, folder):
    return boosted_forecast(_model_days(spark, folder), _BOTH)


# A step by place in the series, at its real keys and days. Boosting from the mean comes nearer to each
# step by the learning rate in every round.
_STEPS = (
    f"WITH {ORDERS}, days AS (SELECT application, source, date, row_number() {_OVER}) AS rn,"
    f" count(*) OVER (PARTITION BY application, source) AS n FROM ({MEASURE_DAYS}) WHERE application IN ('A', 'R')),"
    " steps AS (SELECT *, CASE WHEN rn % 7 >= 5 THEN 10.0 ELSE 20.0 END AS v FROM days WHERE n > 60),"
    " learnt AS (SELECT t.application, t.source, h, avg(ln(t.v)) AS m FROM steps AS t, range(1, 31) AS r(h)"
    " WHERE t.rn > h AND t.rn <= t.n - 30 GROUP BY ALL)"
    " SELECT application, source, h AS horizon, v AS y,"
    f" exp(m + (1 - pow(1 - {BOOST_ETA}, {BOOST_ROUNDS})) * (ln(v) - m)) AS yhat"
    " FROM steps JOIN learnt USING (application, source) WHERE rn = n - 30 + h"
)


@query("boosted_recovers_steps", _STEPS, "application:s source:s horizon:i y:d yhat:d", digits=6)
def boosted_recovers_steps(spark, folder):
    place = F.row_number().over(Window.partitionBy(*_BOTH).orderBy("date"))
    days = _model_days(spark, folder).withColumn("weekday", place % 7)
    value = F.when(F.col("weekday") >= 5, 10.0).otherwise(20.0)
    same = {m: F.lit(1.0) for m in FEATURE_MEASURES}
    return boosted_forecast(days.withColumns({**same, FEATURE_MEASURES[0]: value}), _BOTH)


def _three_models(spark, folder):
    days = _model_days(spark, folder).filter(F.col(FEATURE_MEASURES[0]) > 0)
    return holdout(days, _BOTH)


@query("holdout_scores", digits=4)
def scores_of_three(spark, folder):
    """Train and test scores of trend, additive and boosted models of the same series."""
    return split_scores(staged(_three_models(spark, folder), "holdout"), ["model", *_BOTH])


@query("holdout_comparison", digits=4)
def comparison_of_three(spark, folder):
    return compare_models(holdout_scores(_three_models(spark, folder), _BOTH), _BOTH)


# What the models are asked about: the trend model's share has SQL, and the others the same days.
_ASKED = (
    f"WITH {ORDERS}, days AS (SELECT application, source, date, app_rsp_time, row_number() {_OVER}) AS rn,"
    f" count(*) OVER (PARTITION BY application, source) AS n FROM ({MEASURE_DAYS}) WHERE application IN ('A', 'R') AND app_rsp_time > 0),"
    " held AS (SELECT *, max(CASE WHEN rn = n - 30 THEN date END) OVER (PARTITION BY application, source) AS origin"
    " FROM days WHERE n > 60)"
    " SELECT model, application, source, CAST(date AS TIMESTAMP) AS ds, app_rsp_time AS y FROM held,"
    " (VALUES ('trend'), ('additive'), ('boosted')) AS m(model)"
    " WHERE rn > n - 30 AND (model = 'boosted' OR date_diff('day', origin, date) <= 30)"
)


@query("holdout_frame", _ASKED, "model:s application:s source:s ds:t y:d")
def holdout_frame(spark, folder):
    """The held-out rows of all three models, without what they say."""
    rows = _three_models(spark, folder).filter((F.col("split") == "test") & F.col("yhat").isNotNull())
    return rows.select("model", *_BOTH, "ds", "y")


_TWO_MODELS = (
    f"WITH {EVENTS}, {trend_chain('p10', '48h', '_n')}, {trend_chain('p10', '48h', '_c', cap=True)},"
    f" nulled AS ({metrics('valid_n', 'application, source')}),"
    f" capped AS ({metrics('valid_c', 'application, source')})"
)


def _two_models(spark, folder):
    """Scores of the trend model under the two outlier rules."""
    return {
        name: staged(trend_of(spark, folder, "p10", "48h", rule)["analyse"], f"scores-{name}")
        for name, rule in {"nulled": "q75", "capped": "cap75"}.items()
    }


@query(
    "model_comparison",
    f"{_TWO_MODELS} SELECT application, source, nulled.test_mape AS nulled_mape,"
    " capped.test_mape AS capped_mape FROM nulled JOIN capped USING (application, source)",
    "application:s source:s nulled_mape:d capped_mape:d",
    digits=6,
)
def model_comparison(spark, folder):
    return compare_models(_two_models(spark, folder), _BOTH)


@query(
    "model_score_summary",
    f"{_TWO_MODELS}, scores AS (SELECT 'nulled' AS model, test_mape FROM nulled"
    " UNION ALL SELECT 'capped' AS model, test_mape FROM capped)"
    f" {describe('scores', 'model', ['test_mape'])}",
    "model:s column:s count:i mean:d std:d min:d p25:d p50:d p75:d max:d",
    digits=6,
)
def model_score_summary(spark, folder):
    return score_summary(_two_models(spark, folder), _BOTH)


_TIMED = ", ".join(trend_chain(r, "48h", f"_{r}") for r in ("p1", "p10"))


@query(
    "model_run_time",
    f"WITH {EVENTS}, {_TIMED} " + " UNION ALL ".join(
        f"SELECT '{r}' AS model, count(*) AS series, count(*) > 0 AS timed"
        f" FROM (SELECT DISTINCT application, source FROM series_{r})" for r in ("p1", "p10")
    ),
    "model:s series:i timed:s",
)
def run_time_by_model(spark, folder):
    """Series whose fit was timed; the minutes differ from run to run, and are shown as to whether there are any."""
    fitted = {
        r: fit(data_of(spark, folder, r, "48h"), REPORTS[r], HORIZONS["48h"]) for r in ("p1", "p10")
    }
    return model_run_time(fitted, _BOTH).select("model", "series", (F.col("run_time") > 0).alias("timed"))
