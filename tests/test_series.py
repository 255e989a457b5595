"""Outliers, joins and edge cases of the series, by hand."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficcast.operators import filters
from trafficcast.operators import series as S
from trafficcast.operators.evaluate import error_metrics, with_errors
from trafficcast.operators.outliers import cap_outliers, null_outliers
from trafficcast.plans.reports import REPORTS, data_table, hourly
from trafficcast.operators.forecast import HOURS
from trafficcast.plans.views import monitoring
from trafficcast.schemas import ATTRIBUTE, DATAPOINT

HOUR = 3_600_000


def _points(spark, rows):
    """rows: (hour, application, source, target, attribute, rsp, bytes)"""
    full = [(h * HOUR, *rest) + (0, 0, 0, 0.0, 0, 0) for h, *rest in rows]
    return spark.createDataFrame(full, DATAPOINT)


def _attrs(spark, rows):
    return spark.createDataFrame([(i, None, None, loc, ts) for i, loc, ts in rows], ATTRIBUTE)


def _series(spark, values, key="a"):
    rows = [(key, float(v) if v is not None else None) for v in values]
    return spark.createDataFrame(rows, "k string, y double")


def _ys(df):
    return sorted((r.y for r in df.collect()), key=lambda v: (v is None, v))


def test_spike_is_nulled_or_capped(spark):
    series = _series(spark, [10] * 20 + [100])
    assert _ys(null_outliers(series, ["k"], "y", "y", 0.75)) == [10.0] * 20 + [None]
    assert _ys(cap_outliers(series, ["k"], "y", "y", 0.75)) == [10.0] * 20 + [20.0]


def test_without_far_peak_nothing_changes(spark):
    series = _series(spark, range(1, 21))
    assert _ys(null_outliers(series, ["k"], "y", "y", 0.75)) == [float(v) for v in range(1, 21)]


def test_quantile_of_the_rule_matters(spark):
    values = [1] * 11 + [4] * 8 + [6]
    assert None in _ys(null_outliers(_series(spark, values), ["k"], "y", "y", 0.5))
    assert None not in _ys(null_outliers(_series(spark, values), ["k"], "y", "y", 0.75))


def test_repeated_attribute_doubles_bytes_not_users(spark):
    points = _points(
        spark,
        [(1, "DNS", "s", "u1", 7, 1.0, 100), (1, "DNS", "s", "u2", 7, 1.0, 50), (1, "DNS", "s", "u1", 8, 1.0, 10)],
    )
    attrs = _attrs(spark, [(7, "here", 1), (7, "here", 2), (8, "here", 1)])
    places = S.locations(attrs)
    users = S.hourly_users_location(points, places).first()
    assert (users.location, users.user_count) == ("here", 2)
    assert S.hourly_bytes_location(points, places).first().byte_count_sum == 2 * 150 + 10
    raw = points.join(
        attrs.select(F.col("attribute_id").alias("target_attribute_id"), "location"),
        "target_attribute_id",
        "left",
    )
    assert raw.agg(F.sum("byte_count")).first()[0] == 310
    latest = S.locations(attrs, dedupe_latest=True)
    assert S.hourly_bytes_location(points, latest).first().byte_count_sum == 160


def test_missing_dimension_row_leaves_the_outputs(spark):
    points = _points(spark, [(h, "DNS", "s", "u", 7 + h % 2, 1.0, 100) for h in range(200)])
    spec = REPORTS["p7"]
    hours = hourly(points, _attrs(spark, [(7, "here", 1)]), spec)
    assert {r.location for r in S.series_keys(hours, ["location"]).collect()} == {"here", None}
    data = data_table(hours, spec, HOURS)
    assert {r.location for r in data.select("location").distinct().collect()} == {"here"}
    assert data.count() == 90


def test_cleaning_drops_zero_and_null(spark):
    points = _points(
        spark,
        [(1, "DNS", "s", "u", 1, 0.0, 9), (1, "DNS", "s", "u", 1, 1.0, 0), (1, "DNS", "s", "u", 1, None, 9), (1, "DNS", "s", "u", 1, 2.0, 9)],
    )
    assert filters.nonzero_rows(points).count() == 1


def test_allowlist_is_off_for_application_counts(spark):
    points = _points(spark, [(1, a, "s", "u", 1, 1.0, 1) for a in ("DNS", "SSH", "LDAP")])
    assert hourly(points, None, REPORTS["p2"]).first().app_count == 3
    assert hourly(points, None, REPORTS["p3"]).count() == 2


def test_denylist_optional_in_reports(spark):
    points = _points(spark, [(1, "DNS", s, "u", 1, 1.0, 1) for s in ("s1", "s2")])
    deny = spark.createDataFrame([("s2",), (None,)], "source string")
    assert hourly(points, None, REPORTS["p8"]).count() == 2
    assert [r.source for r in hourly(points, None, REPORTS["p8"], denylist=deny).collect()] == ["s1"]


def test_hot_key_counts_are_whole(spark):
    """A third of the rows on one source and hour."""
    rows = spark.range(30_000).select(
        F.lit(HOUR).alias("time_stamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
        (F.col("id") % 700).cast("string").alias("target_address"),
    )
    got = {r.source: r.user_count for r in S.hourly_users(rows, ["source"]).collect()}
    want = rows.toPandas().groupby("source").target_address.nunique().to_dict()
    assert got == want


def test_zero_actual_has_no_percentage_error(spark):
    pairs = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0)], "k string, y double, yhat double")
    valid = with_errors(pairs)
    assert sorted((r.APE for r in valid.collect()), key=str) == [50.0, None]
    scores = error_metrics(valid, ["k"]).first()
    assert scores.test_rmse == 1.0 and scores.test_mape == 50.0


def test_equal_errors_have_no_clipped_mean(spark):
    pairs = spark.createDataFrame([("a", 2.0, 1.0), ("a", 4.0, 2.0)], "k string, y double, yhat double")
    assert error_metrics(with_errors(pairs), ["k"]).first().test_mape_98 is None


def test_metrics_by_numpy(spark):
    rng = np.random.default_rng(0)
    y, yhat = rng.uniform(1, 9, 48), rng.uniform(1, 9, 48)
    rows = [("a", float(a), float(b)) for a, b in zip(y, yhat)]
    got = error_metrics(with_errors(spark.createDataFrame(rows, "k string, y double, yhat double")), ["k"]).first()
    ape = np.abs((y - yhat) * 100 / y)
    assert got.test_rmse == pytest.approx(np.sqrt(np.mean((y - yhat) ** 2)))
    assert got.std_mape == pytest.approx(ape.std())
    assert got.median_error_rate == pytest.approx(np.median(ape) / 100)
    assert got.test_mape_98 == pytest.approx(ape[ape < np.quantile(ape, 0.98)].mean())


def test_monitoring_uses_own_keys(spark):
    day = dt.date(2024, 1, 1)
    one = spark.createDataFrame([("DNS", "s", day, 1.0, 2.0, 0.1)], "application string, source string, run_date date, test_mape double, test_rmse double, total_run_time double")
    two = spark.createDataFrame([("x", day, 3.0, 4.0, 0.2)], "location string, run_date date, test_mape double, test_rmse double, total_run_time double")
    got = {(r.report, r.application, r.source, r.location, r.metric): r.value for r in monitoring({"p1": one, "p6": two}).collect()}
    assert got[("p1", "DNS", "s", None, "test_mape")] == 1.0
    assert got[("p6", None, None, "x", "total_run_time")] == 0.2
    assert len(got) == 6
