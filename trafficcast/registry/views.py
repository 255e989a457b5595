"""Queries over charts, monitoring and exploration."""

from __future__ import annotations

import datetime as dt

from trafficcast.operators.explore import correlations, hour_means, summary
from trafficcast.operators.filters import before
from trafficcast.operators.forecast import HORIZONS
from trafficcast.plans import views
from trafficcast.plans.exploration import explore
from trafficcast.plans.reports import REPORTS, data_table, hourly
from trafficcast.plans.trend import trend_tables
from trafficcast.registry.core import query
from trafficcast.registry.models import trend_of
from trafficcast.registry.series import data_of, hourly_of
from trafficcast.registry import sql
from trafficcast.registry.sql import EVENTS, ORDERS, analysis, data, describe, trend_chain
from trafficcast.session import staged
from trafficcast.sources.adapters import EVENT_APPS, event_attributes, event_points, order_points
from trafficcast.sources.ingest import midnight_ms

_NIGHTS = (dt.date(2024, 1, 20), dt.date(2024, 1, 25), dt.date(2024, 1, 31))


def _tag(report, night):
    return f"_{report}_{night.day}"


def _cut(night):
    return f"time_stamp < epoch_ms(TIMESTAMP '{night}')"


def _history_sql(reports):
    chains = ", ".join(
        trend_chain(r, "48h", _tag(r, n), _cut(n)) for r in reports for n in _NIGHTS
    )
    tables = {
        r: " UNION ALL ".join(
            f"SELECT *, DATE '{n}' AS run_date FROM ({analysis(r, _tag(r, n))})" for n in _NIGHTS
        )
        for r in reports
    }
    return chains, tables


def _history(spark, folder, report):
    """Analysis rows of the nights, each as of its own midnight."""
    spec, points = REPORTS[report], event_points(spark, folder)
    attrs = event_attributes(spark, folder)
    table = None
    for night in _NIGHTS:
        seen = before(points, midnight_ms(night))
        rows = data_table(hourly(seen, attrs, spec, EVENT_APPS), spec, HORIZONS["48h"])
        one = trend_tables(rows, spec, "48h", night)["analyse"]
        table = one if table is None else table.unionByName(one)
    return staged(table, f"history-{report}")


_MONITORED = tuple(REPORTS)
# A trend model has no fit that takes time, so its third figure is the length of the series.
_SHOWN = ("test_mape", "test_rmse", "length")
_CHAINS, _TABLES = _history_sql(_MONITORED)


def _monitor_sql():
    rows = []
    for report in _MONITORED:
        keys = ", ".join(
            k if k in sql.KEYS[report] else f"CAST(NULL AS VARCHAR) AS {k}"
            for k in ("application", "source", "location")
        )
        for metric in _SHOWN:
            rows.append(
                f"SELECT '{report}' AS report, {keys}, run_date, '{metric}' AS metric,"
                f" CAST({metric} AS DOUBLE) AS value FROM ({_TABLES[report]})"
            )
    return f"WITH {EVENTS}, {_CHAINS} " + " UNION ALL ".join(rows)


@query(
    "monitoring_series",
    _monitor_sql(),
    "report:s application:s source:s location:s run_date:t metric:s value:d",
    digits=6,
)
def monitoring_series(spark, folder):
    histories = {r: _history(spark, folder, r) for r in _MONITORED}
    return views.monitoring(histories, _SHOWN)


_P9_CHAINS, _P9_TABLES = _history_sql(("p9",))


@query(
    "latest_scores",
    f"WITH {EVENTS}, {_P9_CHAINS} SELECT source, max(run_date) AS run_date,"
    " round(arg_max(test_rmse, run_date), 2) AS rmse, round(arg_max(test_mape, run_date), 2) AS mape"
    f" FROM ({_P9_TABLES['p9']}) GROUP BY source",
    "source:s run_date:t rmse:d mape:d",
    digits=6,
)
def latest_scores(spark, folder):
    return views.latest_scores(_history(spark, folder, "p9"), ["source"])


@query(
    "evaluation_chart",
    f"WITH {EVENTS}, {trend_chain('p9', '48h')}, scores AS ({analysis('p9')}),"
    " earlier AS (SELECT d.source, d.date, d.bw FROM data AS d JOIN (SELECT source, min(ds) AS start"
    " FROM valid GROUP BY source) AS v ON d.source = v.source AND d.date < start"
    " QUALIFY dense_rank() OVER (PARTITION BY d.source ORDER BY d.date DESC) <= 30),"
    " lines AS (SELECT source, 'train_data' AS kind, date AS ds, bw AS value FROM earlier"
    " UNION ALL SELECT source, 'actual', ds, y FROM valid"
    " UNION ALL SELECT source, 'predicted', ds, yhat FROM valid)"
    " SELECT source, kind, ds, value, round(test_rmse, 2) AS rmse, round(test_mape, 2) AS mape"
    " FROM lines JOIN scores USING (source)",
    "source:s kind:s ds:t value:d rmse:d mape:d",
    digits=6,
)
def evaluation_chart(spark, folder):
    tables = trend_of(spark, folder, "p9", "48h")
    rows = data_of(spark, folder, "p9", "48h")
    return views.evaluation_chart(rows, tables["valid"], tables["analyse"], REPORTS["p9"], 30)


@query(
    "user_chart",
    f"WITH {ORDERS}, {trend_chain('p9', '30d')}, recent AS (SELECT * FROM data"
    " QUALIFY dense_rank() OVER (PARTITION BY source ORDER BY date DESC) <= 30)"
    " SELECT source, 'train_data' AS kind, CAST(date AS TIMESTAMP) AS ds, bw AS value FROM recent"
    " UNION ALL SELECT source, 'forecast', ds, yhat FROM ahead",
    "source:s kind:s ds:t value:d",
    digits=6,
)
def user_chart(spark, folder):
    ahead = trend_of(spark, folder, "p9", "30d")["forecast"]
    return views.user_chart(data_of(spark, folder, "p9", "30d"), ahead, REPORTS["p9"], 30)


# -- exploration -------------------------------------------------------------

_SUMMARY_KINDS = "column:s count:i mean:d std:d min:d p25:d p50:d p75:d max:d"


@query(
    "series_summary",
    f"WITH {ORDERS}, hours AS ({sql.hourly('p10', '30d')})"
    f" {describe('hours', 'application, source', ['bw'])}",
    f"application:s source:s {_SUMMARY_KINDS}",
    digits=8,
)
def series_summary(spark, folder):
    return summary(hourly_of(spark, folder, "p10", "30d"), ["application", "source"], ["bw"])


@query(
    "frame_summary",
    f"WITH {ORDERS}, hours AS ({sql.hourly('p7', '30d')})"
    f" {describe('hours', '', ['time_stamp', 'byte_count_sum', 'bw'])}",
    _SUMMARY_KINDS,
    digits=3,
)
def frame_summary(spark, folder):
    hours = hourly_of(spark, folder, "p7", "30d")
    return summary(hours, [], ["time_stamp", "byte_count_sum", "bw"])


_NUMBERS = ("app_rsp_time", "byte_count", "flow_count", "tcp_rsp_time")


def _corr_sql(table):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM {table}"
        for a in _NUMBERS
        for b in _NUMBERS
    )


@query(
    "correlation_matrix",
    f"WITH {ORDERS}, rows_kept AS (SELECT * FROM pts WHERE app_rsp_time <> 0) {_corr_sql('rows_kept')}",
    "column_a:s column_b:s corr:d",
    digits=8,
)
def correlation_matrix(spark, folder):
    points = order_points(spark, folder)
    return correlations(points.filter(points.app_rsp_time != 0), _NUMBERS)


_MEANS = ", ".join(f"avg({c}) AS {c}" for c in _NUMBERS)


@query(
    "hour_means",
    f"WITH {ORDERS} SELECT time_stamp, {_MEANS} FROM pts WHERE app_rsp_time <> 0 GROUP BY time_stamp",
    "time_stamp:i " + " ".join(f"{c}:d" for c in _NUMBERS),
    digits=8,
)
def hour_means_query(spark, folder):
    points = order_points(spark, folder)
    return hour_means(points.filter(points.app_rsp_time != 0), _NUMBERS)


@query(
    "correlation_hour_means",
    f"WITH {ORDERS}, hours AS (SELECT time_stamp, {_MEANS} FROM pts WHERE app_rsp_time <> 0"
    f" GROUP BY time_stamp) {_corr_sql('hours')}",
    "column_a:s column_b:s corr:d",
    digits=8,
)
def correlation_hour_means(spark, folder):
    return correlations(hour_means_query(spark, folder), _NUMBERS)


# One series, as an analyst selects it.
_KEY = {"application": "A", "source": "s1"}
_ONE = (
    f"WITH {ORDERS}, one AS (SELECT * FROM pts WHERE application = 'A' AND source = 's1'"
    " AND app_rsp_time <> 0), hours AS (SELECT application, source, time_stamp, "
    f"{_MEANS} FROM one GROUP BY application, source, time_stamp)"
)


def _exploration_query(part, body, kinds):
    @query(f"explore_{part}", f"{_ONE} {body}", kinds, digits=8)
    def run(spark, folder):
        return explore(order_points(spark, folder), "app_rsp_time", _NUMBERS, **_KEY)[part]


_exploration_query("rows", _corr_sql("one"), "column_a:s column_b:s corr:d")
_exploration_query("hours", _corr_sql("hours"), "column_a:s column_b:s corr:d")
_exploration_query(
    "summary",
    describe("hours", "application, source", ["app_rsp_time"]),
    f"application:s source:s {_SUMMARY_KINDS}",
)
_exploration_query(
    "daily",
    "SELECT application, source, CAST(epoch_ms(time_stamp) AS DATE) AS date,"
    " max(app_rsp_time) AS app_rsp_time FROM hours GROUP BY application, source, date",
    "application:s source:s date:t app_rsp_time:d",
)
