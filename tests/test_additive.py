"""Invariants of the additive model."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trafficcast.functions import additive
from trafficcast.functions.additive import DAY, fit_predict
from trafficcast.operators.forecast import DAYS, HOURS, additive_fit, additive_models, forecast_only, model_frame, score_models

HOUR = 3600.0
WEEKLY = np.array([0, 1, 3, -2, 5, 2, -4])


def _linear_weekly(days):
    return 2.0 * days + 100 + WEEKLY[days % 7]


def test_recovers_line_and_week():
    past, future = np.arange(120), np.arange(120, 150)
    yhat = fit_predict(past * DAY, _linear_weekly(past), future * DAY, 0.1, 0.05)
    assert np.allclose(yhat, _linear_weekly(future), rtol=1e-2)


def test_recovers_day_in_hours():
    past, future = np.arange(90), np.arange(90, 138)
    wave = lambda h: 50 + 0.1 * h + 5 * np.sin(2 * np.pi * h / 24)
    yhat = fit_predict(past * HOUR, wave(past), future * HOUR, 0.1, 0.05)
    assert np.allclose(yhat, wave(future), rtol=1e-2)


def test_scale_equivariance():
    rng = np.random.default_rng(3)
    t, y = np.arange(90) * DAY, 50 + rng.normal(0, 3, 90)
    ahead = t[-1] + DAY * np.arange(1, 31)
    one, thousand = (fit_predict(t, c * y, ahead, 0.03, 0.2) for c in (1, 1000))
    assert np.allclose(1000 * one, thousand)


def _some_series(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.choice([12, 30, 61, 90]))
    t = np.sort(rng.choice(200, n, replace=False)) * (DAY if seed % 2 else HOUR)
    y = [
        50 + np.cumsum(rng.normal(0, 1, n)),
        rng.exponential(5, n),
        100 + 0.3 * np.arange(n) + 3 * np.sin(2 * np.pi * np.arange(n) / 7),
        rng.integers(0, 3, n).astype(float),
    ][seed % 4]
    y[rng.random(n) < (0.2 if seed % 5 == 0 else 0)] = np.nan
    return t, y


@pytest.mark.parametrize("seed", [*range(40), 60, 300])
def test_every_fit_is_proven_optimal(seed):
    found = additive.fit(*_some_series(seed), (0.03, 0.1, 0.2, 0.5)[seed % 4], 0.05 if seed % 2 else 0.2)
    assert found.converged and found.gap <= additive.GAP


@pytest.mark.parametrize("seed", range(20))
def test_lasso_is_the_minimum(seed):
    """The gap bounds the distance to any other point, and nothing near is better."""
    rng = np.random.default_rng(seed)
    n, weight = int(rng.integers(1, 12)), float(rng.uniform(0.1, 3))
    root = rng.normal(size=(n, n)) @ np.diag(10.0 ** rng.uniform(-3, 1, n))
    A, b = root.T @ root + 1e-6 * np.eye(n), rng.normal(0, 2, n)

    def value(v):
        return v @ A @ v / 2 - b @ v + weight * np.abs(v).sum()

    x, gap = additive.lasso(A, b, weight)
    slack = 1e-9 * max(1, abs(value(x)))
    assert gap <= slack
    for _ in range(300):
        assert value(x) <= value(x + rng.normal(0, 10.0 ** rng.uniform(-6, 0), n)) + slack
    slow = np.zeros(n)
    for _ in range(200):
        slow = additive._sweep(A, b, weight, slow)
    assert value(x) <= value(slow) + slack


def test_a_broken_line_gives_few_slope_changes():
    t = np.arange(90) * DAY
    y = 100 + np.where(np.arange(90) < 36, 0.5 * np.arange(90), 18 + 2.0 * (np.arange(90) - 36))
    y = y + np.random.default_rng(1).normal(0, 0.2, 90)
    found = additive.fit(t, y, 0.1, 0.05)
    assert found.converged and np.count_nonzero(found.bends) < len(found.bends) / 2
    assert abs(found.knots[np.abs(found.bends).argmax()] * 89 - 36) <= 3
    assert np.allclose(additive.predict(found, t), y, rtol=0.02)


def test_deterministic_and_finite():
    rng = np.random.default_rng(4)
    t, y = np.arange(90) * HOUR, rng.exponential(5, 90)
    ahead = t[-1] + HOUR * np.arange(1, 49)
    a, b = (fit_predict(t, y, ahead, 0.1, 0.05) for _ in range(2))
    assert np.array_equal(a, b) and np.isfinite(a).all()


@pytest.mark.parametrize("seed", range(5))
def test_looser_changepoints_fit_no_worse(seed):
    rng = np.random.default_rng(seed)
    t = np.arange(90) * DAY
    y = 50 + np.cumsum(rng.normal(0, 1, 90))
    errors = [np.sum((fit_predict(t, y, t, c, 0.2) - y) ** 2) for c in (0.01, 0.03, 0.1, 0.5, 2)]
    assert all(later <= earlier * 1.01 for earlier, later in zip(errors, errors[1:]))


def test_missing_point_moves_a_noise_free_fit_little():
    days = np.arange(120)
    y = _linear_weekly(days).astype(float)
    gap = y.copy()
    gap[50] = np.nan
    ahead = np.arange(120, 150) * DAY
    assert np.allclose(
        fit_predict(days * DAY, y, ahead, 0.1, 0.05), fit_predict(days * DAY, gap, ahead, 0.1, 0.05), rtol=1e-3
    )


@pytest.mark.parametrize("values", [[7.0], [np.nan, 3.0], [0.0, 0.0, 0.0], [4.0] * 12])
def test_degenerate_series(values):
    t = np.arange(len(values)) * DAY
    assert np.isfinite(fit_predict(t, values, t[-1] + DAY * np.arange(1, 4), 0.1, 0.05)).all()


# -- on Spark ----------------------------------------------------------------


def _frame(spark, key, times, values):
    rows = pd.DataFrame({"source": key, "ds": times, "y": np.asarray(values, dtype=float)})
    return spark.createDataFrame(rows, "source string, ds timestamp, y double")


def _days(n, start="2024-01-01"):
    return pd.date_range(start, periods=n, freq="D")


def _fit(series, horizon=DAYS, outlier=None):
    return additive_fit(model_frame(series, ["source"], horizon, outlier), ["source"], horizon, 0.1, 0.05)


def test_steps_after_the_last_day_and_pairs(spark):
    times = _days(100)
    out = _fit(_frame(spark, "a", times, _linear_weekly(np.arange(100)))).toPandas()
    ahead = out[out.kind == "forecast"].sort_values("ds")
    assert list(ahead.ds) == list(_days(30, "2024-04-10"))
    assert np.allclose(ahead.yhat, _linear_weekly(np.arange(100, 130)), rtol=1e-2)
    valid = out[out.kind == "valid"].sort_values("ds")
    assert list(valid.ds) == list(times[70:])
    assert np.allclose(valid.y, _linear_weekly(np.arange(70, 100)))
    assert set(out.length) == {100}


def test_gap_in_the_hold_out_is_dropped(spark):
    """The hold-out is the last 30 observed days, its calendar 30 days after the training part."""
    keep = np.array([d for d in range(103) if d not in (80, 81, 82)])
    times = _days(103)[keep]
    out = _fit(_frame(spark, "a", times, _linear_weekly(keep))).toPandas()
    valid = sorted(out[out.kind == "valid"].ds)
    observed = set(times[70:])
    calendar = pd.date_range(times[69] + pd.Timedelta(days=1), periods=30)
    assert valid == [d for d in calendar if d in observed]
    assert len(valid) == 27


def test_same_result_for_any_partitioning(spark):
    rng = np.random.default_rng(7)
    parts = [_frame(spark, f"s{i}", _days(90), 40 + rng.normal(0, 4, 90)) for i in range(5)]
    series = parts[0]
    for p in parts[1:]:
        series = series.union(p)

    def rows(df):
        got = _fit(df).select("source", "kind", "ds", "y", "yhat").toPandas()
        return got.sort_values(["source", "kind", "ds"]).reset_index(drop=True)

    pd.testing.assert_frame_equal(rows(series.coalesce(1)), rows(series.repartition(13)))


def test_forecast_only_caps_and_needs_points(spark):
    spike = np.full(40, 10.0)
    spike[20] = 100.0
    series = _frame(spark, "a", _days(40), spike).union(_frame(spark, "b", _days(9), np.full(9, 5.0)))
    out = forecast_only(series, ["source"]).toPandas()
    assert set(out.source) == {"a"} and len(out) == 30
    assert out.yhat.between(5, 25).all()


def test_hourly_series_needs_ninety_points(spark):
    series = None
    for n in (60, 89, 90, 91):
        one = _frame(spark, f"n{n}", pd.date_range("2024-01-01", periods=n, freq="h"), np.arange(n) + 10)
        series = one if series is None else series.union(one)
    modelled = model_frame(series, ["source"], HOURS).select("source").distinct()
    assert sorted(r.source for r in modelled.collect()) == ["n90", "n91"]


def test_daily_series_needs_more_than_sixty_points(spark):
    series = _frame(spark, "n60", _days(60), np.arange(60)).union(_frame(spark, "n61", _days(61), np.arange(61)))
    modelled = model_frame(series, ["source"], DAYS).select("source").distinct()
    assert [r.source for r in modelled.collect()] == ["n61"]


def test_too_few_usable_points_give_no_rows(spark):
    values = np.full(70, np.nan)
    values[:9] = 5.0
    series = _frame(spark, "a", _days(70), values).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    frame = model_frame(series, ["source"], DAYS, "q75", min_usable=10)
    assert frame.count() == 0


def test_fits_show_their_gap(spark):
    rng = np.random.default_rng(8)
    out = _fit(_frame(spark, "a", _days(90), 40 + rng.normal(0, 4, 90))).toPandas()
    assert out.converged.all() and (out.gap <= additive.GAP).all()


@pytest.mark.parametrize("horizon", [DAYS, HOURS])
def test_stored_models_forecast_like_the_fit(spark, horizon, tmp_path):
    rng = np.random.default_rng(9)
    series = None
    for i in range(3):
        times = pd.date_range("2024-01-01", periods=95, freq="D" if horizon is DAYS else "h")
        one = _frame(spark, f"s{i}", times, 50 + np.cumsum(rng.normal(0, 1, 95)))
        series = one if series is None else series.union(one)
    frame = model_frame(series, ["source"], horizon)
    path = str(tmp_path / "models")
    additive_models(frame, ["source"], horizon, 0.1, 0.05).write.parquet(path)
    scored = score_models(spark.read.parquet(path), ["source"], horizon).toPandas()
    fitted = additive_fit(frame, ["source"], horizon, 0.1, 0.05).filter("kind = 'forecast'").toPandas()
    both = scored.merge(fitted, on=["source", "ds"], suffixes=("", "_fit"))
    assert len(both) == len(scored) == len(fitted) == 3 * horizon.delay
    assert np.allclose(both.yhat, both.yhat_fit, rtol=1e-12)


def test_models_may_be_asked_for_later_steps(spark):
    series = _frame(spark, "a", _days(100), _linear_weekly(np.arange(100)))
    models = additive_models(model_frame(series, ["source"], DAYS), ["source"], DAYS, 0.1, 0.05)
    later = score_models(models, ["source"], DAYS, after=pd.Timestamp("2024-05-01").date(), steps=7).toPandas()
    days = (later.ds - pd.Timestamp("2024-01-01")).dt.days.to_numpy()
    assert sorted(days) == list(range(122, 129))
    assert np.allclose(later.yhat, _linear_weekly(days), rtol=1e-2)
