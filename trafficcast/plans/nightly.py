"""A night's work: every report and horizon, each step written once and read back."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from trafficcast.constants import DEFAULT_APPS
from trafficcast.operators.forecast import HORIZONS
from trafficcast.operators.grain import base_grain
from trafficcast.operators.series import locations, roll_up_bytes, with_bandwidth
from trafficcast.plans.reports import (
    REPORTS,
    ReportSpec,
    analysis_table,
    data_table,
    fit,
    forecast_table,
    hourly_of_grain,
    valid_table,
)
from trafficcast.plans.views import monitoring
from trafficcast.session import scratch_path
from trafficcast.sources.files import drop_folder, table_exists
from trafficcast.sources.sinks import log_run, observed, write_history, write_latest, write_replace

RUN_LOG_TABLE = "run_time_table_agg"


def result_path(base: str, spec: ReportSpec, kind: str, horizon: str) -> str:
    return f"{base.rstrip('/')}/{spec.result_table(kind, horizon)}"


def _written(df: DataFrame, path: str) -> DataFrame:
    write_replace(df, path)
    return df.sparkSession.read.parquet(path)


def publish(
    series: DataFrame,
    spec: ReportSpec,
    horizon: str,
    base: str,
    run_date: dt.date,
    scratch: str,
    realtime: bool = True,
    replace_forecast: bool = False,
    replace_analysis: bool = False,
) -> tuple[float, dict[str, int]]:
    """Writes the tables of one report and horizon below `base`; returns its seconds and the rows by table.

    Rows are counted by the jobs that write them.

    The data table is the input of the fit and the written fit that of the other
    three, so nothing is computed twice and a lost executor costs its tasks only.
    Without `realtime` only the analysis is published.
    """
    started = time.monotonic()
    grain = HORIZONS[horizon]
    staging = f"{scratch}/{spec.name}-{horizon}"

    def path(kind: str) -> str:
        return result_path(base, spec, kind, horizon)

    watched = {}

    def counted(kind: str, df: DataFrame) -> DataFrame:
        df, watched[kind] = observed(df)
        return df

    table = counted("data", data_table(series, spec, grain))
    data = _written(table, path("data") if realtime else f"{staging}-data")
    fitted = _written(fit(data, spec, grain), f"{staging}-fit")
    if realtime:
        write_replace(counted("valid", valid_table(fitted, spec)), path("valid"))
        ahead = counted("forecast", forecast_table(fitted, spec, run_date))
        write_latest(ahead, path("forecast"), run_date, replace_forecast)
    scores = counted("analyse", analysis_table(fitted, spec, run_date))
    write_history(scores, path("analyse"), run_date, replace_analysis)
    return time.monotonic() - started, {kind: watch.get["rows"] for kind, watch in watched.items()}


def run_night(
    spark: SparkSession,
    points: DataFrame,
    attrs: DataFrame,
    base: str,
    run_date: dt.date,
    reports: Iterable[str] = tuple(REPORTS),
    horizons: Sequence[str] = tuple(HORIZONS),
    apps: Sequence[str] = DEFAULT_APPS,
    dedupe_latest: bool = False,
    realtime: bool = True,
    replace_forecast: bool = False,
    replace_analysis: bool = False,
    at_once: int = 4,
    denylist: DataFrame | None = None,
) -> None:
    """All reports. The measurements are read once, into the base grain; horizons share the hourly series
    of a report, and p9 is p10 summed over applications. A denylist, if given, is applied to all.

    Reports do not depend on each other: several are submitted at once, so that
    one fills the cluster while another finishes its last tasks.
    """
    wanted = list(reports)
    scratch = scratch_path(spark, "night")
    roll_up = "p9" in wanted and "p10" in wanted

    def series_of(name: str) -> DataFrame:
        spec = REPORTS[name]
        denied = denylist if denylist is None or set(spec.keys) & set(denylist.columns) else None
        rows = hourly_of_grain(grain, places, spec, apps, denied)
        return _written(rows, f"{scratch}/hourly-{name}")

    def written(report: str, rows: DataFrame, horizon: str) -> tuple[float, dict[str, int]]:
        return publish(
            rows,
            REPORTS[report],
            horizon,
            base,
            run_date,
            scratch,
            realtime,
            replace_forecast,
            replace_analysis,
        )

    def one(name: str) -> list[tuple[str, str, float, dict[str, int]]]:
        """A report with both horizons, and with the report that is its sum."""
        started = time.monotonic()
        series = {name: series_of(name)}
        shared = time.monotonic() - started
        if roll_up and name == "p10":
            coarse = roll_up_bytes(series["p10"], REPORTS["p9"].keys)
            series["p9"] = _written(with_bandwidth(coarse), f"{scratch}/hourly-p9")
        entries = []
        for report, rows in series.items():
            for horizon in horizons:
                seconds, counts = written(report, rows, horizon)
                entries.append((report, horizon, shared + seconds, counts))
        return entries

    try:
        grain = _written(base_grain(points), f"{scratch}/grain")
        places = _written(locations(attrs, dedupe_latest), f"{scratch}/places")
        alone = [name for name in wanted if not (roll_up and name == "p9")]
        with ThreadPoolExecutor(at_once) as pool:
            done = [entry for entries in pool.map(one, alone) for entry in entries]
        # One after another: appends to the same folder must not overlap.
        for name, horizon, seconds, counts in done:
            label = f"{name}({REPORTS[name].table})"
            log_run(spark, f"{base.rstrip('/')}/{RUN_LOG_TABLE}", label, horizon, seconds, run_date, counts)
    finally:
        drop_folder(spark, scratch)


def monitor(spark: SparkSession, base: str, horizon: str) -> DataFrame:
    """Monitoring series of every report that has results below `base`."""
    paths = {n: result_path(base, spec, "analyse", horizon) for n, spec in REPORTS.items()}
    found = {n: spark.read.parquet(p) for n, p in paths.items() if table_exists(spark, p)}
    return monitoring(found)
