"""Features, boosted trees and the comparison of models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trafficcast.constants import FEATURE_MEASURES
from trafficcast.functions import boosting
from trafficcast.operators.boosted import boosted_forecast, boosted_holdout
from trafficcast.operators.compare import compare_models, score_summary
from trafficcast.operators.evaluate import split_scores
from trafficcast.operators.features import lag_means, minmax_scale, multi_targets, robust_scale
from trafficcast.plans.holdout import holdout


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(5)
    frames = []
    for i, key in enumerate(("a", "b")):
        days = pd.date_range("2024-01-01", periods=80, freq="D")
        frame = pd.DataFrame(rng.uniform(1, 9, (80, len(FEATURE_MEASURES))), columns=list(FEATURE_MEASURES))
        frame["app_rsp_time"] = (i + 1) * 10 + frame.byte_count / 10
        frame["source"], frame["date"], frame["weekday"] = key, days.date, days.weekday
        frames.append(frame)
    return spark.createDataFrame(pd.concat(frames))


def test_lag_mean_by_pandas(spark, daily):
    got = lag_means(daily, ["source"], ["byte_count"]).toPandas().sort_values(["source", "date"])
    raw = daily.toPandas().sort_values(["source", "date"])
    for key, part in raw.groupby("source"):
        want = part.byte_count.shift(1).rolling(5).mean()
        want[:5] = part.byte_count[:5]
        assert np.allclose(got[got.source == key].byte_count, want)


def test_training_targets_stay_inside_the_training_part(daily):
    frame = boosted_holdout(daily, ["source"], rounds=3).toPandas()
    assert set(frame.split) == {"train", "test"}
    last = pd.Timestamp("2024-01-01") + pd.Timedelta(days=49)
    landing = pd.to_datetime(frame.origin) + pd.to_timedelta(frame.horizon, unit="D")
    assert (landing == pd.to_datetime(frame.ds)).all()
    assert (landing[frame.split == "train"] <= last).all()
    test = frame[frame.split == "test"]
    assert (pd.to_datetime(test.origin) == last).all()
    assert sorted(test[test.source == "a"].horizon) == list(range(1, 31))


def test_boosted_forecast_beats_a_constant(daily):
    out = boosted_forecast(daily, ["source"], rounds=40).toPandas()
    assert len(out) == 60 and np.isfinite(out.yhat).all()
    for _, part in out.groupby("source"):
        assert abs(part.yhat.mean() - part.y.mean()) < 0.3 * part.y.mean()


def _slow_trees(x, y, other, rounds, depth, rate, least):
    """One target at a time, split by split."""

    def grow(rows, level):
        best = (1e-12, None)
        if level:
            for f in range(x.shape[1]):
                for cut in sorted(set(x[rows, f]))[:-1]:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) >= least:
                        r = residual
                        gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut, left, right))
        if best[1] is None:
            return lambda row: rate * residual[rows].mean()
        f, cut, left, right = best[1]
        low, high = grow(left, level - 1), grow(right, level - 1)
        return lambda row: low(row) if row[f] <= cut else high(row)

    rows = np.flatnonzero(~np.isnan(y))
    said, beyond = np.full(len(x), y[rows].mean()), np.full(len(other), y[rows].mean())
    for _ in range(rounds):
        residual = np.where(np.isnan(y), 0, y - said)
        tree = grow(rows, depth)
        said, beyond = said + [tree(r) for r in x], beyond + [tree(r) for r in other]
    return said, beyond


@pytest.mark.parametrize("seed", range(4))
def test_trees_equal_trees_grown_one_by_one(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 9, (40, 3)).astype(float) + rng.permutation(120).reshape(40, 3) / 1e4 * (seed % 2)
    x = np.round(x, 0) if seed % 2 == 0 else x[:20]
    y = rng.normal(0, 1, (len(x), 4)) + x[:, :1]
    y[rng.random(y.shape) < 0.2] = np.nan
    other = rng.integers(0, 9, (5, 3)).astype(float)
    codes, other_codes = boosting.binned(x, other)
    fitted, beyond = boosting.boosted_trees(x, y, other, 6, 3, 0.3, 3)
    for h in range(4):
        slow, slow_beyond = _slow_trees(codes, y[:, h], other_codes, 6, 3, 0.3, 3)
        assert np.allclose(fitted[:, h], slow) and np.allclose(beyond[:, h], slow_beyond)


def test_time_for_a_series_does_not_depend_on_the_others(spark, daily):
    """Ten times the series are ten groups more, each with its own small table."""
    many = daily.crossJoin(spark.range(5)).withColumn("source", F.concat("source", F.col("id").cast("string"))).drop("id")
    one, all_of_them = (boosted_forecast(df, ["source"], rounds=5).toPandas() for df in (daily, many))
    for i in range(5):
        part = all_of_them[all_of_them.source == f"a{i}"].sort_values("horizon").yhat.to_numpy()
        assert np.allclose(part, one[one.source == "a"].sort_values("horizon").yhat)


def test_all_models_are_asked_about_the_same_days(daily):
    rows = holdout(daily, ["source"], rounds=10).toPandas()
    asked = {m: set(part[part.split == "test"].ds) for m, part in rows.groupby("model")}
    assert set(asked) == {"trend", "additive", "boosted"}
    assert asked["trend"] == asked["additive"] == asked["boosted"] and len(asked["trend"]) == 30
    seen = rows[(rows.split == "train") & (rows.model != "boosted")].groupby(["model", "source"]).size()
    assert (seen == 50).all()
    scores = {(r.model, r.source, r.split): r.rmse for r in split_scores(
        daily.sparkSession.createDataFrame(rows), ["model", "source"]).collect()}
    for key, part in rows.groupby(["model", "source", "split"]):
        assert scores[key] == pytest.approx(np.sqrt(((part.y - part.yhat) ** 2).mean()), abs=0.006)


def test_multi_targets_drop_the_tail(daily):
    got = multi_targets(daily, ["source"], "app_rsp_time", horizons=30)
    assert got.count() == 2 * 50
    assert got.filter("y30 IS NULL").count() == 0


def test_scaling_of_a_constant_column(spark):
    rows = spark.createDataFrame([("a", 3.0), ("a", 3.0)], "k string, v double")
    for scale in (minmax_scale, robust_scale):
        got = scale(rows, ["k"], ["v"], inverse=True).toPandas()
        assert (got.v_scaled == 0).all() and (got.v_restored == 3).all()


def test_comparison_pivots_by_model(spark):
    one = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, test_mape double")
    two = spark.createDataFrame([("a", 2.0), ("b", 5.0)], "source string, test_mape double")
    wide = {r.source: (r.m1_mape, r.m2_mape) for r in compare_models({"m1": one, "m2": two}, ["source"]).collect()}
    assert wide == {"a": (1.0, 2.0), "b": (3.0, 5.0)}
    medians = {r.model: r.p50 for r in score_summary({"m1": one, "m2": two}, ["source"]).collect()}
    assert medians == {"m1": 2.0, "m2": 3.5}
