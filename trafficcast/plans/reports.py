"""The eight reports: what differs between them, and the plan they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.constants import DEFAULT_APPS, MIN_USABLE_POINTS
from trafficcast.functions.columns import event_time
from trafficcast.operators.evaluate import error_metrics, with_errors
from trafficcast.operators.filters import allow_apps, drop_denied, nonzero_rows, with_keys
from trafficcast.operators.forecast import HORIZONS, Horizon, additive_fit, model_frame
from trafficcast.operators.grain import grain_rows, hourly_rsp_time_of
from trafficcast.operators.series import (
    daily_peak,
    hourly_app_count,
    hourly_bytes,
    hourly_bytes_location,
    hourly_peak,
    hourly_rsp_time,
    hourly_users,
    hourly_users_location,
    last_points,
    locations,
    with_bandwidth,
)


@dataclass(frozen=True)
class ReportSpec:
    name: str
    table: str
    keys: tuple[str, ...]
    value: str
    aggregate: Callable[..., DataFrame]
    allowlist: bool = True
    clean: bool = False
    outlier: str | None = None
    # (changepoint, seasonality) prior scale per horizon
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    min_usable: int = 0
    # The same series from the base grain, where it is not what `aggregate` makes of the grain's rows.
    from_grain: Callable[..., DataFrame] | None = None

    @property
    def by_location(self) -> bool:
        return "location" in self.keys

    def result_table(self, kind: str, horizon: str) -> str:
        suffix = "_48hrs" if horizon == "48h" else ""
        return f"{kind}_{self.table}{suffix}"


def _both(changepoint: float, seasonality: float) -> dict[str, tuple[float, float]]:
    return {name: (changepoint, seasonality) for name in HORIZONS}


_APP_SOURCE = ("application", "source")

# Keys, rules, prior scales and table names of each report.
REPORTS = {
    spec.name: spec
    for spec in (
        ReportSpec(
            "p1", "apprsptime_per_app_per_source", _APP_SOURCE, "app_rsp_time",
            hourly_rsp_time, outlier="q75", scales=_both(0.1, 0.05), min_usable=MIN_USABLE_POINTS,
            from_grain=hourly_rsp_time_of,
        ),
        ReportSpec(
            "p2", "nofapps_per_source", ("source",), "app_count",
            hourly_app_count, allowlist=False, scales={"30d": (0.03, 0.2), "48h": (0.2, 0.2)},
        ),
        ReportSpec(
            "p3", "nofusers_per_app_per_source", _APP_SOURCE, "user_count",
            lambda points: hourly_users(points, _APP_SOURCE), scales=_both(0.03, 0.2),
        ),
        ReportSpec(
            "p6", "nofusers_per_location", ("location",), "user_count",
            hourly_users_location, outlier="q75", scales=_both(0.03, 0.2),
        ),
        ReportSpec(
            "p7", "bw_per_location", ("location",), "bw",
            lambda points, places: with_bandwidth(hourly_bytes_location(points, places)),
            clean=True, outlier="q50", scales=_both(0.1, 0.05),
        ),
        ReportSpec(
            "p8", "nofusers_per_source", ("source",), "user_count",
            lambda points: hourly_users(points, ["source"]), scales=_both(0.03, 0.2),
        ),
        ReportSpec(
            "p9", "bw_per_source", ("source",), "bw",
            lambda points: with_bandwidth(hourly_bytes(points, ["source"])),
            clean=True, outlier="q50", scales=_both(0.1, 0.05),
        ),
        ReportSpec(
            "p10", "bw_per_app_per_source", _APP_SOURCE, "bw",
            lambda points: with_bandwidth(hourly_bytes(points, _APP_SOURCE)),
            clean=True, outlier="q75", scales=_both(0.1, 0.05),
        ),
    )
}


def hourly(
    points: DataFrame,
    attrs: DataFrame | None,
    spec: ReportSpec,
    apps: Sequence[str] = DEFAULT_APPS,
    denylist: DataFrame | None = None,
    dedupe_latest: bool = False,
) -> DataFrame:
    """Filtered hourly series of a report: keys..., time_stamp, value. Both horizons start here.

    A report by location weighs its dimension when this is called.
    """
    rows = nonzero_rows(points) if spec.clean else points
    places = locations(attrs, dedupe_latest) if spec.by_location else None
    return _aggregated(rows, places, spec, spec.aggregate, apps, denylist)


def hourly_of_grain(
    grain: DataFrame,
    places: DataFrame | None,
    spec: ReportSpec,
    apps: Sequence[str] = DEFAULT_APPS,
    denylist: DataFrame | None = None,
) -> DataFrame:
    """The same series from the base grain of the measurements and the `locations` of the attributes."""
    rows = grain_rows(grain, spec.clean)
    return _aggregated(rows, places, spec, spec.from_grain or spec.aggregate, apps, denylist)


def _aggregated(rows, places, spec, aggregate, apps, denylist):
    if spec.allowlist:
        rows = allow_apps(rows, apps)
    series = aggregate(rows, places) if spec.by_location else aggregate(rows)
    if denylist is not None:
        series = drop_denied(series, denylist, "location" if spec.by_location else "source")
    return series


def data_table(hourly_series: DataFrame, spec: ReportSpec, horizon: Horizon) -> DataFrame:
    """The modelled series: daily peaks, or the last hours. Columns date, value, keys."""
    kept = with_keys(hourly_series, spec.keys)
    if horizon.name == "30d":
        series = daily_peak(kept, spec.keys, [spec.value])
    else:
        recent = last_points(hourly_peak(kept, spec.keys, [spec.value]), spec.keys, "time_stamp")
        series = recent.withColumn("date", event_time("time_stamp"))
    return series.select("date", spec.value, *spec.keys)


def as_series(data: DataFrame, spec: ReportSpec) -> DataFrame:
    """A data table in the shape the models take: keys..., ds, y."""
    return data.select(
        *spec.keys,
        F.col("date").cast("timestamp").alias("ds"),
        F.col(spec.value).cast("double").alias("y"),
    )


def fit(data: DataFrame, spec: ReportSpec, horizon: Horizon) -> DataFrame:
    """Forecast and validation rows of a data table, from one pass over its series."""
    frame = model_frame(
        as_series(data, spec), spec.keys, horizon, spec.outlier, spec.min_usable
    )
    return additive_fit(frame, spec.keys, horizon, *spec.scales[horizon.name])


def forecast_table(fitted: DataFrame, spec: ReportSpec, run_date: dt.date) -> DataFrame:
    ahead = fitted.filter(F.col("kind") == "forecast")
    return ahead.select("ds", "yhat", *spec.keys, F.lit(run_date).alias("run_date"))


def valid_table(fitted: DataFrame, spec: ReportSpec) -> DataFrame:
    pairs = with_errors(fitted.filter(F.col("kind") == "valid"))
    return pairs.select("ds", "y", "yhat", "error_test", "APE", *spec.keys)


def analysis_table(fitted: DataFrame, spec: ReportSpec, run_date: dt.date) -> DataFrame:
    pairs = with_errors(fitted.filter(F.col("kind") == "valid"))
    scores = error_metrics(pairs, spec.keys, carry=["length", "fit_seconds"])
    return scores.select(
        "length",
        "test_rmse",
        "test_mape",
        "std_mape",
        "min_error_rate",
        "max_error_rate",
        "median_error_rate",
        "test_mape_98",
        F.round(F.col("fit_seconds") / 60, 8).alias("total_run_time"),
        *spec.keys,
        F.lit(run_date).alias("run_date"),
    )


def report(
    points: DataFrame,
    attrs: DataFrame | None,
    spec: ReportSpec,
    horizon: str,
    run_date: dt.date,
    apps: Sequence[str] = DEFAULT_APPS,
    denylist: DataFrame | None = None,
    dedupe_latest: bool = False,
) -> dict[str, DataFrame]:
    """The four result tables as lazy DataFrames.

    Each computes its own lineage when read alone; `nightly.publish` writes all
    four from one computation.
    """
    grain = HORIZONS[horizon]
    data = data_table(hourly(points, attrs, spec, apps, denylist, dedupe_latest), spec, grain)
    fitted = fit(data, spec, grain)
    return {
        "data": data,
        "forecast": forecast_table(fitted, spec, run_date),
        "valid": valid_table(fitted, spec),
        "analyse": analysis_table(fitted, spec, run_date),
    }
