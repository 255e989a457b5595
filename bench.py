"""Times the headline queries and prints one JSON line.

The published figure of the reference is seconds per modelled series, so that
is the metric here: the forecast and validation of every (application, source)
series of the events table, 100 sources wide, including the scan.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from trafficcast.plans.nightly import run_night
from trafficcast.plans.reports import REPORTS, data_table, fit, hourly
from trafficcast.operators.boosted import boosted_forecast
from trafficcast.operators.forecast import HORIZONS
from trafficcast.operators.series import daily_peak_measures, hourly_measures
from trafficcast.registry import QUERIES
from trafficcast.session import build_session, scratch_path
from trafficcast.sources.adapters import EVENT_APPS, event_attributes, event_points, order_points
from trafficcast.sources.ingest import retained

HEADLINE = (
    "hourly_rsp_time",
    "hourly_users_location",
    "hourly_bw_location",
    "daily_peak_p10",
    "tail90_p10",
    "outlier_null_q75",
    "trend_analysis_p9_48h",
    "additive_analysis_p1_30d",
    "additive_analysis_p2_30d",
    "additive_analysis_p7_48h",
    "additive_analysis_p9_48h",
    "additive_analysis_p10_48h",
    "correlation_matrix",
    "frame_summary",
)


def run(df) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    spec, grain = REPORTS["p10"], HORIZONS["48h"]
    points = event_points(spark, folder, sources=100)

    def many():
        return fit(data_table(hourly(points, None, spec, EVENT_APPS), spec, grain), spec, grain)

    run(many())  # starts the Python workers and compiles the plan
    times["many_series_48h"] = run(many())
    series = many().select(*spec.keys).distinct().count()

    # The published comparison: daily response-time series over the days the store keeps.
    kept = retained(order_points(spark, folder))
    p1 = REPORTS["p1"]
    daily = data_table(hourly(kept, None, p1, ("A", "N", "R")), p1, HORIZONS["30d"])
    times["daily_12_series_additive"] = run(fit(daily, p1, HORIZONS["30d"]))
    measures = daily_peak_measures(hourly_measures(kept, p1.keys), p1.keys)
    started = time.perf_counter()
    boosted_forecast(measures, p1.keys).collect()
    times["daily_12_series_boosted"] = time.perf_counter() - started

    for name in HEADLINE:
        times[name] = run(QUERIES[name](spark, folder))

    base = scratch_path(spark, "bench-night")
    started = time.perf_counter()
    run_night(
        spark,
        event_points(spark, folder),
        event_attributes(spark, folder),
        base,
        dt.date(2024, 1, 31),
        horizons=["48h"],
        apps=EVENT_APPS,
    )
    times["night_48h_all_reports"] = time.perf_counter() - started

    print(
        json.dumps(
            {
                "metric": "additive_model_seconds_per_series",
                "value": round(times["many_series_48h"] / max(series, 1), 5),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "series": series,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
