"""One night: ingest both tables, then run the reports.

    spark-submit -m trafficcast --points <table> --attributes <table> --store <folder> --results <folder>
"""

from __future__ import annotations

import argparse
import datetime as dt

from trafficcast.constants import DEFAULT_APPS
from trafficcast.operators.forecast import HORIZONS
from trafficcast.plans.nightly import run_night
from trafficcast.plans.reports import REPORTS
from trafficcast.schemas import ATTRIBUTE, DATAPOINT
from trafficcast.session import build_session
from trafficcast.sources.ingest import ingest
from trafficcast.sources.tables import open_source, read_attributes, read_datapoints


def main() -> None:
    parser = argparse.ArgumentParser(prog="trafficcast")
    parser.add_argument("--format", default="parquet", help="source format")
    parser.add_argument("--option", action="append", default=[], help="source option, key=value")
    parser.add_argument("--points", required=True, help="path, or database table, of the measurements")
    parser.add_argument("--attributes", required=True, help="the same of the device attributes")
    parser.add_argument("--store", required=True)
    parser.add_argument("--results", required=True)
    parser.add_argument("--reports", nargs="+", default=list(REPORTS), choices=list(REPORTS))
    parser.add_argument("--horizons", nargs="+", default=list(HORIZONS), choices=list(HORIZONS))
    parser.add_argument("--apps", nargs="+", default=list(DEFAULT_APPS))
    parser.add_argument("--run-date", type=dt.date.fromisoformat, default=None)
    parser.add_argument("--dedupe-latest", action="store_true", help="one location per attribute id")
    parser.add_argument("--no-publish", action="store_true", help="score only: no data, forecast or hold-out tables")
    parser.add_argument("--replace-forecast", action="store_true")
    parser.add_argument("--replace-analysis", action="store_true")
    args = parser.parse_args()

    spark = build_session()
    today = args.run_date or dt.datetime.now(dt.timezone.utc).date()
    options = dict(o.split("=", 1) for o in args.option)
    named_by = "dbtable" if args.format == "jdbc" else "path"
    stores = {}
    for name, path, schema, trim in (
        ("datapoint", args.points, DATAPOINT, True),
        ("attribute", args.attributes, ATTRIBUTE, False),
    ):
        source = open_source(spark, args.format, **{named_by: path}, **options)
        stores[name] = f"{args.store.rstrip('/')}/{name}"
        ingest(source, stores[name], schema, today, trim)

    run_night(
        spark,
        read_datapoints(spark, stores["datapoint"]),
        read_attributes(spark, stores["attribute"], with_time=args.dedupe_latest),
        args.results,
        today,
        args.reports,
        args.horizons,
        args.apps,
        args.dedupe_latest,
        realtime=not args.no_publish,
        replace_forecast=args.replace_forecast,
        replace_analysis=args.replace_analysis,
    )
    spark.stop()


if __name__ == "__main__":
    main()
