"""Queries over filters, hourly series and the model grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficcast.constants import DELAY_HOURS, FEATURE_MEASURES
from trafficcast.operators import filters
from trafficcast.operators import series as S
from trafficcast.operators.forecast import DAYS, HORIZONS, HOURS, future_calendar, holdout_split
from trafficcast.operators.grain import base_grain
from trafficcast.operators.outliers import cap_outliers, null_outliers
from trafficcast.plans.reports import REPORTS, as_series, data_table, hourly, hourly_of_grain
from trafficcast.plans.views import last_dates
from trafficcast.registry.core import query
from trafficcast.registry.sql import (
    APPS,
    EVENTS,
    KEYS,
    ORDERS,
    POINTS,
    VALUE,
    data,
    outlier,
)
from trafficcast.registry import sql
from trafficcast.sources.adapters import (
    EVENT_APPS,
    ORDER_APPS,
    denied,
    event_attributes,
    event_points,
    order_attributes,
    order_points,
)

SOURCES = {
    "48h": (event_points, event_attributes, EVENT_APPS),
    "30d": (order_points, order_attributes, ORDER_APPS),
}

KIND = {"app_rsp_time": "d", "bw": "d", "app_count": "i", "user_count": "i"}


def hourly_of(spark, folder, report, horizon):
    points, attrs, apps = SOURCES[horizon]
    return hourly(points(spark, folder), attrs(spark, folder), REPORTS[report], apps)


def data_of(spark, folder, report, horizon):
    spec = REPORTS[report]
    return data_table(hourly_of(spark, folder, report, horizon), spec, HORIZONS[horizon])


def series_of(spark, folder, report, horizon):
    return as_series(data_of(spark, folder, report, horizon), REPORTS[report])


# -- filters -----------------------------------------------------------------

_ROW = "time_stamp, application, source, byte_count, app_rsp_time"
_ROW_COLUMNS = _ROW.split(", ")
_ROW_KINDS = "time_stamp:i application:s source:s byte_count:i app_rsp_time:d"


@query(
    "app_allowlist",
    f"WITH {ORDERS} SELECT {_ROW} FROM pts WHERE application IN ({APPS['30d']})",
    _ROW_KINDS,
)
def app_allowlist(spark, folder):
    return filters.allow_apps(order_points(spark, folder), ORDER_APPS).select(*_ROW_COLUMNS)


@query(
    "nonzero_rows",
    f"WITH {ORDERS} SELECT {_ROW} FROM pts WHERE app_rsp_time <> 0 AND byte_count <> 0",
    _ROW_KINDS,
)
def nonzero_rows(spark, folder):
    return filters.nonzero_rows(order_points(spark, folder)).select(*_ROW_COLUMNS)


@query(
    "denylist_anti",
    f"WITH {ORDERS} SELECT {_ROW} FROM pts WHERE source <> (SELECT max(source) FROM pts)",
    _ROW_KINDS,
)
def denylist_anti(spark, folder):
    points = order_points(spark, folder)
    return filters.drop_denied(points, denied(points)).select(*_ROW_COLUMNS)


@query(
    "length_gate",
    f"WITH {ORDERS}, data AS ({data('p1', '30d')}) SELECT application, source, count(*) AS length"
    " FROM data GROUP BY application, source HAVING count(*) > 60",
    "application:s source:s length:i",
)
def length_gate(spark, folder):
    keys = REPORTS["p1"].keys
    gated = filters.long_enough(data_of(spark, folder, "p1", "30d"), keys)
    return gated.select(*keys, "length").distinct()


def _eligible_sql(report, denied_on, before_value_filter=False):
    hours = sql.hourly(report, "30d")
    if before_value_filter:
        hours = hours.rsplit(" HAVING ", 1)[0]
    keys = ", ".join(KEYS[report])
    return (
        f"WITH {ORDERS} SELECT {keys}, count(*) AS count, 1 AS count_flag FROM ({hours})"
        f" WHERE {denied_on} <> (SELECT max({denied_on}) FROM (SELECT source, location FROM pts"
        f" LEFT JOIN attrs ON target_attribute_id = attribute_id)) GROUP BY {keys} HAVING count(*) > 60"
    )


@query(
    "eligible_combinations",
    _eligible_sql("p1", "source", before_value_filter=True),
    "application:s source:s count:i count_flag:i",
)
def eligible_combinations(spark, folder):
    """Counted before hours with a zero mean are dropped."""
    points = filters.allow_apps(order_points(spark, folder), ORDER_APPS)
    hours = points.groupBy("application", "source", "time_stamp").agg(F.avg("app_rsp_time"))
    return S.eligible(hours, REPORTS["p1"].keys, denied(order_points(spark, folder)))


@query(
    "eligible_bandwidth",
    _eligible_sql("p10", "source"),
    "application:s source:s count:i count_flag:i",
)
def eligible_bandwidth(spark, folder):
    hours = hourly_of(spark, folder, "p10", "30d")
    return S.eligible(hours, REPORTS["p10"].keys, denied(order_points(spark, folder)))


@query("eligible_locations", _eligible_sql("p7", "location"), "location:s count:i count_flag:i")
def eligible_locations(spark, folder):
    hours = hourly_of(spark, folder, "p7", "30d")
    places = order_attributes(spark, folder).agg(F.max("location").alias("location"))
    return S.eligible(hours, ["location"], places, "location")


@query(
    "min_points",
    f"WITH {EVENTS}, series AS (SELECT application, source, CAST(date AS TIMESTAMP) AS ds,"
    f" app_rsp_time AS y FROM ({data('p1', '48h')})),"
    f" kept AS ({outlier('series', 'application, source', 0.75)})"
    " SELECT application, source, count(y) AS usable FROM kept GROUP BY application, source HAVING count(y) >= 80",
    "application:s source:s usable:i",
)
def min_points(spark, folder):
    """Series with at least 80 usable hours: a level that some of them miss."""
    keys = REPORTS["p1"].keys
    kept = null_outliers(series_of(spark, folder, "p1", "48h"), keys, "y", "y", 0.75)
    enough = filters.enough_usable(kept, keys, ["y"], at_least=80)
    return enough.groupBy(*keys).agg(F.count("y").alias("usable"))


# -- hourly aggregates -------------------------------------------------------


def _hourly_query(name, report, horizon="30d"):
    keys = "".join(f"{k}:s " for k in KEYS[report])
    value = f"{VALUE[report]}:{KIND[VALUE[report]]}"
    extra = " byte_count_sum:i" if VALUE[report] == "bw" else ""

    @query(name, f"WITH {POINTS[horizon]} {sql.hourly(report, horizon)}", f"{keys}time_stamp:i {value}{extra}")
    def run(spark, folder):
        return hourly_of(spark, folder, report, horizon)


for _name, _report in {
    "hourly_rsp_time": "p1",
    "hourly_app_count": "p2",
    "hourly_users_app_source": "p3",
    "hourly_users_location": "p6",
    "hourly_bw_location": "p7",
    "hourly_users_source": "p8",
    "hourly_bw_source": "p9",
    "hourly_bw_app_source": "p10",
}.items():
    _hourly_query(_name, _report)


def _grain_query(report, horizon):
    keys = "".join(f"{k}:s " for k in KEYS[report])
    value = f"{VALUE[report]}:{KIND[VALUE[report]]}"
    extra = " byte_count_sum:i" if VALUE[report] == "bw" else ""

    @query(f"grain_hourly_{report}_{horizon}", f"WITH {POINTS[horizon]} {sql.hourly(report, horizon)}", f"{keys}time_stamp:i {value}{extra}")
    def run(spark, folder):
        """The report's hourly series from the one base grain."""
        points, attrs, apps = SOURCES[horizon]
        grain = base_grain(points(spark, folder))
        return hourly_of_grain(grain, S.locations(attrs(spark, folder)), REPORTS[report], apps)


for _report in REPORTS:
    for _horizon in HORIZONS:
        _grain_query(_report, _horizon)


@query(
    "base_grain",
    f"WITH {EVENTS} SELECT application, source, target_attribute_id, target_address, time_stamp, sum(app_rsp_time) AS rsp_sum,"
    " count(app_rsp_time) AS rsp_count, CAST(sum(byte_count) AS BIGINT) AS bytes,"
    " count(*) FILTER (WHERE app_rsp_time <> 0 AND byte_count <> 0) AS clean_rows,"
    " CAST(sum(byte_count) FILTER (WHERE app_rsp_time <> 0 AND byte_count <> 0) AS BIGINT) AS clean_bytes FROM pts GROUP BY ALL",
    "application:s source:s target_attribute_id:i target_address:s time_stamp:i rsp_sum:d rsp_count:i bytes:i"
    " clean_rows:i clean_bytes:i",
    digits=8,
)
def base_grain_query(spark, folder):
    return base_grain(event_points(spark, folder))


@query(
    "hourly_bw_rolled_up",
    f"WITH {ORDERS} {sql.hourly('p9', '30d')}",
    "source:s time_stamp:i byte_count_sum:i bw:d",
)
def hourly_bw_rolled_up(spark, folder):
    """The per-source series from the finer one per application and source."""
    return S.with_bandwidth(S.roll_up_bytes(hourly_of(spark, folder, "p10", "30d"), ["source"]))


_MEASURES = ", ".join(f"avg({m}) AS {m}" for m in FEATURE_MEASURES)
_MEASURE_KINDS = " ".join(f"{m}:d" for m in FEATURE_MEASURES)
MEASURE_HOURS = (
    f"SELECT application, source, time_stamp, {_MEASURES} FROM pts"
    " GROUP BY application, source, time_stamp HAVING avg(app_rsp_time) <> 0"
)
MEASURE_DAYS = (
    "SELECT application, source, CAST(epoch_ms(time_stamp) AS DATE) AS date, "
    + ", ".join(f"max({m}) AS {m}" for m in FEATURE_MEASURES)
    + ", max(isodow(epoch_ms(time_stamp)) - 1) AS weekday"
    + f" FROM ({MEASURE_HOURS}) GROUP BY application, source, date"
)


def measures_of(spark, folder):
    return S.hourly_measures(order_points(spark, folder), ["application", "source"])


def daily_measures_of(spark, folder):
    return S.daily_peak_measures(measures_of(spark, folder), ["application", "source"])


@query(
    "hourly_multi_mean",
    f"WITH {ORDERS} {MEASURE_HOURS}",
    f"application:s source:s time_stamp:i {_MEASURE_KINDS}",
    digits=8,
)
def hourly_multi_mean(spark, folder):
    return measures_of(spark, folder)


@query(
    "daily_peak_multi",
    f"WITH {ORDERS} {MEASURE_DAYS}",
    f"application:s source:s date:t {_MEASURE_KINDS} weekday:i",
    digits=8,
)
def daily_peak_multi(spark, folder):
    return daily_measures_of(spark, folder)


# -- data tables -------------------------------------------------------------


def _data_query(name, report, horizon):
    keys = "".join(f"{k}:s " for k in KEYS[report])
    value = f"{VALUE[report]}:{KIND[VALUE[report]]}"

    @query(name, f"WITH {POINTS[horizon]} {data(report, horizon)}", f"{keys}date:t {value}")
    def run(spark, folder):
        return data_of(spark, folder, report, horizon)


for _report in REPORTS:
    _data_query(f"daily_peak_{_report}", _report, "30d")
    _data_query(f"tail90_{_report}", _report, "48h")


@query(
    "series_keys",
    f"WITH {ORDERS} SELECT DISTINCT application, source FROM ({sql.hourly('p10', '30d')})",
    "application:s source:s",
)
def series_keys(spark, folder):
    return S.series_keys(hourly_of(spark, folder, "p10", "30d"), ["application", "source"])


@query(
    "holdout_split",
    f"WITH {EVENTS} SELECT source, date AS ds, bw AS y,"
    f" CASE WHEN row_number() OVER (PARTITION BY source ORDER BY date DESC) <= {DELAY_HOURS}"
    f" THEN 'test' ELSE 'train' END AS part FROM ({data('p9', '48h')})",
    "source:s ds:t y:d part:s",
)
def split_query(spark, folder):
    split = holdout_split(series_of(spark, folder, "p9", "48h"), ["source"], DELAY_HOURS)
    part = F.when(F.col("is_test"), "test").otherwise("train").alias("part")
    return split.select("source", "ds", "y", part)


@query(
    "last_n_dates",
    f"WITH {ORDERS} SELECT application, source, date, bw FROM ({data('p10', '30d')})"
    " QUALIFY dense_rank() OVER (PARTITION BY application, source ORDER BY date DESC) <= 30",
    "application:s source:s date:t bw:d",
)
def last_n_dates(spark, folder):
    return last_dates(data_of(spark, folder, "p10", "30d"), ["application", "source"], 30)


@query(
    "future_calendar",
    f"WITH {ORDERS} SELECT source, CAST(max(date) + CAST(h AS INTEGER) AS TIMESTAMP) AS ds"
    f" FROM ({data('p9', '30d')}), range(1, 31) AS r(h) GROUP BY source, h",
    "source:s ds:t",
)
def calendar_days(spark, folder):
    last = series_of(spark, folder, "p9", "30d").groupBy("source").agg(F.max("ds").alias("last"))
    return future_calendar(last, "last", DAYS).select("source", "ds")


@query(
    "future_calendar_hours",
    f"WITH {EVENTS} SELECT source, max(date) + to_hours(CAST(h AS INTEGER)) AS ds"
    f" FROM ({data('p9', '48h')}), range(1, 49) AS r(h) GROUP BY source, h",
    "source:s ds:t",
)
def calendar_hours(spark, folder):
    last = series_of(spark, folder, "p9", "48h").groupBy("source").agg(F.max("ds").alias("last"))
    return future_calendar(last, "last", HOURS).select("source", "ds")


# -- outliers ----------------------------------------------------------------


def _outlier_query(name, rule, q, cap, horizon):
    series = (
        f"WITH {POINTS[horizon]}, series AS (SELECT application, source,"
        f" CAST(date AS TIMESTAMP) AS ds, bw AS y FROM ({data('p10', horizon)}))"
    )

    @query(name, f"{series} {outlier('series', 'application, source', q, cap)}", "application:s source:s ds:t y:d")
    def run(spark, folder):
        series = series_of(spark, folder, "p10", horizon)
        return rule(series, ["application", "source"], "y", "y", q)


for _horizon in ("48h", "30d"):
    _tag = "" if _horizon == "48h" else "_daily"
    _outlier_query(f"outlier_null_q75{_tag}", null_outliers, 0.75, False, _horizon)
    _outlier_query(f"outlier_null_q50{_tag}", null_outliers, 0.50, False, _horizon)
    _outlier_query(f"outlier_cap_q75{_tag}", cap_outliers, 0.75, True, _horizon)
