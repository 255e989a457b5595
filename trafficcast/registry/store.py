"""Queries over scans, ingest and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.plans.nightly import RUN_LOG_TABLE, run_night
from trafficcast.plans.reports import REPORTS, data_table, hourly
from trafficcast.plans.trend import trend_tables
from trafficcast.operators.filters import before
from trafficcast.operators.forecast import HORIZONS
from trafficcast.registry.core import query
from trafficcast.registry.sql import APPS, EVENTS, KEYS, ORDERS, analysis, data, trend_chain
from trafficcast.schemas import DATAPOINT
from trafficcast.session import scratch_path
from trafficcast.sources import ingest, sinks
from trafficcast.sources.adapters import (
    EVENT_APPS,
    event_attributes,
    event_points,
    order_attributes,
    order_points,
)
from trafficcast.sources.tables import load_csv, pull_window, read_attributes, read_datapoints

_POINT_COLUMNS = ["time_stamp", "application", "source", "target_address", "app_rsp_time", "byte_count"]
_POINT_KINDS = "time_stamp:i application:s source:s target_address:s app_rsp_time:d byte_count:i"
_POINTS = f"SELECT {', '.join(_POINT_COLUMNS)} FROM pts"

# A night in the middle of the order lines, and the 90 days before it.
_TODAY = dt.date(2001, 6, 1)
_MIDNIGHT = "epoch_ms(TIMESTAMP '2001-06-01')"
_START = f"{_MIDNIGHT} - CAST(90 AS BIGINT) * 86400000"


def _bootstrapped(spark, folder):
    """Order lines bootstrapped into a fresh store: (source, path)."""
    points = order_points(spark, folder)
    path = scratch_path(spark, "datapoints")
    ingest.bootstrap(points, path, DATAPOINT, _TODAY)
    return points, path


@query("scan_datapoints", f"WITH {EVENTS} {_POINTS}", _POINT_KINDS)
def scan_datapoints(spark, folder):
    """All events, from a store that keeps them all."""
    path = scratch_path(spark, "datapoints")
    ingest.bootstrap(event_points(spark, folder), path, DATAPOINT, dt.date(2100, 1, 1), days=130 * 366)
    return read_datapoints(spark, path).select(*_POINT_COLUMNS)


@query(
    "scan_attributes_pruned",
    f"WITH {ORDERS} SELECT attribute_id, location FROM attrs",
    "attribute_id:i location:s",
)
def scan_attributes_pruned(spark, folder):
    path = scratch_path(spark, "attributes")
    attrs = order_attributes(spark, folder).withColumn("event_date", F.to_date(F.lit("2001-06-01")))
    attrs.write.partitionBy("event_date").parquet(path)
    return read_attributes(spark, path).select("attribute_id", "location")


@query(
    "csv_load_headers",
    f"WITH {EVENTS} SELECT time_stamp, application, target_attribute_id, byte_count FROM pts",
    "time_stamp:i application:s target_attribute_id:i byte_count:i",
)
def csv_load_headers(spark, folder):
    path = scratch_path(spark, "csv")
    event_points(spark, folder).select(
        F.col("time_stamp").alias("time _stamp"),
        F.col("application").alias(" application"),
        F.col("target_attribute_id").alias("target_attribute_id "),
        F.col("byte_count").alias("byte _count"),
    ).write.option("header", True).csv(path)
    return load_csv(spark, path, scratch_path(spark, "loaded"))


@query(
    "window_pull",
    f"WITH {ORDERS} {_POINTS} WHERE time_stamp > {_START} AND time_stamp <= {_MIDNIGHT}",
    _POINT_KINDS,
)
def window_pull(spark, folder):
    hi = ingest.midnight_ms(_TODAY)
    lo = hi - 90 * 86_400_000
    return pull_window(order_points(spark, folder), lo, hi, closed="right").select(*_POINT_COLUMNS)


@query(
    "high_water_mark",
    f"WITH {ORDERS} SELECT max(time_stamp) AS time_stamp FROM pts",
    "time_stamp:i",
)
def high_water_mark(spark, folder):
    return ingest.high_water_mark(order_points(spark, folder))


@query(
    "pending_points",
    f"WITH {ORDERS} SELECT count(DISTINCT time_stamp) AS count FROM pts WHERE time_stamp >"
    f" (SELECT max(time_stamp) FROM pts WHERE time_stamp < {_MIDNIGHT})",
    "count:i",
)
def pending_points(spark, folder):
    points = order_points(spark, folder)
    stored = before(points, ingest.midnight_ms(_TODAY))
    return ingest.pending_points(points, stored)


@query("bootstrap_90d", f"WITH {ORDERS} {_POINTS} WHERE time_stamp >= {_START} AND time_stamp < {_MIDNIGHT}", _POINT_KINDS)
def bootstrap_90d(spark, folder):
    points = order_points(spark, folder)
    return ingest.bootstrap_window(points, _TODAY).select(*_POINT_COLUMNS)


@query("incremental_append", f"WITH {ORDERS} {_POINTS} WHERE time_stamp >= {_START}", _POINT_KINDS)
def incremental_append(spark, folder):
    points, path = _bootstrapped(spark, folder)
    ingest.append_incremental(points, path, DATAPOINT)
    return read_datapoints(spark, path).select(*_POINT_COLUMNS)


@query(
    "align_schema",
    f"WITH {EVENTS} SELECT time_stamp, byte_count, application FROM pts",
    "time_stamp:i byte_count:i application:s",
)
def align_schema(spark, folder):
    shuffled = event_points(spark, folder).select(
        F.col("application"), F.col("byte_count").cast("string"), F.col("time_stamp")
    )
    wanted = [DATAPOINT[n] for n in ("time_stamp", "byte_count", "application")]
    return ingest.align(shuffled, T.StructType(wanted))


@query(
    "retain_90d",
    f"WITH {ORDERS} {_POINTS} WHERE time_stamp >= (SELECT max(time_stamp) FROM pts) - CAST(90 AS BIGINT) * 86400000",
    _POINT_KINDS,
)
def retain_90d(spark, folder):
    return ingest.retained(order_points(spark, folder)).select(*_POINT_COLUMNS)


@query(
    "ingest_night",
    f"WITH {ORDERS} {_POINTS} WHERE time_stamp >= (SELECT max(time_stamp) FROM pts) - CAST(90 AS BIGINT) * 86400000",
    _POINT_KINDS,
)
def ingest_night(spark, folder):
    """First night bootstraps, the next appends and trims the store."""
    points = order_points(spark, folder)
    path = scratch_path(spark, "datapoints")
    for _ in range(2):
        ingest.ingest(points, path, DATAPOINT, _TODAY, trim=True)
    return read_datapoints(spark, path).select(*_POINT_COLUMNS)


@query("as_of_cut", f"WITH {ORDERS} {_POINTS} WHERE time_stamp < {_MIDNIGHT}", _POINT_KINDS)
def as_of_cut(spark, folder):
    return before(order_points(spark, folder), ingest.midnight_ms(_TODAY)).select(*_POINT_COLUMNS)


# -- sinks -------------------------------------------------------------------

# Two nights of the 48-hour bandwidth report: as of the first, and with all events.
_FIRST, _SECOND = dt.date(2024, 1, 20), dt.date(2024, 1, 31)
_FIRST_CUT = "time_stamp < epoch_ms(TIMESTAMP '2024-01-20')"


def _nights(spark, folder):
    """(run date, data table, trend result tables) of the two nights."""
    spec, points = REPORTS["p9"], event_points(spark, folder)
    for night, seen in ((_FIRST, before(points, ingest.midnight_ms(_FIRST))), (_SECOND, points)):
        table = data_table(hourly(seen, None, spec, EVENT_APPS), spec, HORIZONS["48h"])
        yield night, table, trend_tables(table, spec, "48h", night)


@query(
    "replace_sink",
    f"WITH {EVENTS} {data('p9', '48h')}",
    "source:s date:t bw:d",
)
def replace_sink(spark, folder):
    path = scratch_path(spark, "data")
    for _, table, _ in _nights(spark, folder):
        sinks.write_replace(table, path)
    return spark.read.parquet(path)


@query(
    "latest_partition_sink",
    f"WITH {EVENTS}, {trend_chain('p9', '48h')}"
    " SELECT source, ds, yhat, DATE '2024-01-31' AS run_date FROM ahead",
    "source:s ds:t yhat:d run_date:t",
    digits=6,
)
def latest_partition_sink(spark, folder):
    path = scratch_path(spark, "forecast")
    for night, _, tables in _nights(spark, folder):
        sinks.write_latest(tables["forecast"], path, night)
    return sinks.read_latest(spark, path)


_TWO_NIGHTS = (
    f"WITH {EVENTS}, {trend_chain('p9', '48h', '_a', _FIRST_CUT)}, {trend_chain('p9', '48h', '_b')}"
    f" SELECT *, DATE '2024-01-20' AS run_date FROM ({analysis('p9', '_a')})"
    f" UNION ALL BY NAME SELECT *, DATE '2024-01-31' AS run_date FROM ({analysis('p9', '_b')})"
)


def _history(spark, folder):
    path = scratch_path(spark, "analyse")
    for night, _, tables in _nights(spark, folder):
        sinks.write_history(tables["analyse"], path, night)
    # The second night runs again: its rows are replaced, not doubled.
    sinks.write_history(tables["analyse"], path, night)
    return spark.read.parquet(path)


@query(
    "history_sink",
    _TWO_NIGHTS,
    "source:s length:i test_rmse:d test_mape:d std_mape:d min_error_rate:d max_error_rate:d"
    " median_error_rate:d test_mape_98:d run_date:t",
    digits=6,
)
def history_sink(spark, folder):
    return _history(spark, folder)


@query(
    "distinct_run_dates",
    f"SELECT DISTINCT run_date FROM ({_TWO_NIGHTS})",
    "run_date:t",
)
def distinct_run_dates(spark, folder):
    return sinks.run_dates(_history(spark, folder))


def _log_sql():
    rows, chains = [], []
    for report in ("p9", "p10"):
        for horizon in ("30d", "48h"):
            tag, keys = f"_{report}_{horizon}", ", ".join(KEYS[report])
            # Both horizons of a night read the same measurements, here the events.
            chains.append(trend_chain(report, horizon, tag).replace(APPS["30d"], APPS["48h"]))
            rows.append(
                f"SELECT '{report}({REPORTS[report].table})' AS report, '{horizon}' AS horizon, DATE '2024-01-31' AS run_date,"
                f" (SELECT count(*) FROM data{tag}) AS data_rows, (SELECT count(*) FROM ahead{tag}) AS forecast_rows,"
                f" (SELECT count(*) FROM valid{tag}) AS valid_rows,"
                f" (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM valid{tag})) AS analyse_rows, true AS timed"
            )
    return f"WITH {EVENTS}, {', '.join(chains)} " + " UNION ALL ".join(rows)


@query(
    "run_time_history",
    _log_sql(),
    "report:s horizon:s run_date:t data_rows:i forecast_rows:i valid_rows:i analyse_rows:i timed:s",
)
def run_time_history(spark, folder):
    """The log of a night's bandwidth reports with the rows they wrote; minutes differ from run to run."""
    base = scratch_path(spark, "night")
    run_night(
        spark,
        event_points(spark, folder),
        event_attributes(spark, folder),
        base,
        _SECOND,
        reports=["p9", "p10"],
        apps=EVENT_APPS,
    )
    log = sinks.read_run_log(spark, f"{base}/{RUN_LOG_TABLE}")
    counts = [c for c in log.columns if c.endswith("_rows")]
    return log.select("report", "horizon", "run_date", *counts, (F.col("run_time") > 0).alias("timed"))
