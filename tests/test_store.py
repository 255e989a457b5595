"""Ingest windows, retention, sinks and a whole night, in fresh folders."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from trafficcast.functions.columns import event_date
from trafficcast.operators.filters import allow_apps
from trafficcast.plans.nightly import RUN_LOG_TABLE, monitor, result_path, run_night
from trafficcast.plans.reports import REPORTS, report
from trafficcast.schemas import ATTRIBUTE, DATAPOINT
from trafficcast.sources import ingest as I
from trafficcast.sources import sinks
from trafficcast.sources.adapters import EVENT_APPS, event_attributes, event_points
from trafficcast.sources.files import partitions, table_exists
from trafficcast.sources.tables import load_csv, pull_window, read_datapoints
from trafficcast.streaming import increments
from trafficcast.streaming.increments import follow

DAY = 86_400_000
TODAY = dt.date(2024, 6, 1)
MIDNIGHT = I.midnight_ms(TODAY)


def _at(spark, times):
    rows = [(t, "DNS", "s", "u", 1, 1.0, 1, 0, 0, 0, 0.0, 0, 0) for t in times]
    return spark.createDataFrame(rows, DATAPOINT)


def _times(df):
    return sorted(r.time_stamp for r in df.select("time_stamp").collect())


def test_windows_include_one_bound(spark):
    rows = _at(spark, [1, 2, 3])
    assert _times(pull_window(rows, 1, 3, "left")) == [1, 2]
    assert _times(pull_window(rows, 1, 3, "right")) == [2, 3]
    with pytest.raises(ValueError):
        pull_window(rows, 1, 3, "both")


def test_first_night_takes_ninety_whole_days(spark, tmp_path):
    lo = MIDNIGHT - 90 * DAY
    path = str(tmp_path / "points")
    I.bootstrap(_at(spark, [lo - 1, lo, MIDNIGHT - 1, MIDNIGHT]), path, DATAPOINT, TODAY)
    assert _times(read_datapoints(spark, path)) == [lo, MIDNIGHT - 1]


def test_next_night_takes_what_is_above_the_mark(spark, tmp_path):
    path = str(tmp_path / "points")
    I.bootstrap(_at(spark, [MIDNIGHT - 5000]), path, DATAPOINT, TODAY)
    late = MIDNIGHT - 6000  # below the mark: never picked up
    source = _at(spark, [late, MIDNIGHT - 5000, MIDNIGHT, MIDNIGHT + 7])
    assert I.pending_points(source, read_datapoints(spark, path)).first()["count"] == 2
    I.append_incremental(source, path, DATAPOINT)
    I.append_incremental(source, path, DATAPOINT)
    assert _times(read_datapoints(spark, path)) == [MIDNIGHT - 5000, MIDNIGHT, MIDNIGHT + 7]


@pytest.mark.parametrize("offset", [0, 5 * 3_600_000])
def test_retention_trims_within_a_date(spark, tmp_path, offset):
    path = str(tmp_path / "points")
    mark = MIDNIGHT + offset
    floor = mark - 90 * DAY
    times = [floor - 2 * DAY, floor - 1, floor, floor + 1, mark]
    I._append(_at(spark, times), DATAPOINT, path)
    lazily = _times(I.retained(read_datapoints(spark, path)))
    I.retain(spark, path, DATAPOINT)
    assert _times(read_datapoints(spark, path)) == [floor, floor + 1, mark] == lazily


def test_retention_of_an_emptied_boundary_date(spark, tmp_path):
    path = str(tmp_path / "points")
    mark = MIDNIGHT + 12 * 3_600_000
    I._append(_at(spark, [mark - 90 * DAY - 1, mark]), DATAPOINT, path)
    I.retain(spark, path, DATAPOINT)
    assert _times(read_datapoints(spark, path)) == [mark]
    assert len(partitions(spark, path, "event_date")) == 1


def test_ingest_chooses_by_existence(spark, tmp_path):
    path = str(tmp_path / "points")
    source = _at(spark, [MIDNIGHT - 100 * DAY, MIDNIGHT - 89 * DAY, MIDNIGHT - 1, MIDNIGHT + 5 * DAY])
    assert I.ingest(source, path, DATAPOINT, TODAY, trim=True) == "bootstrap"
    assert I.ingest(source, path, DATAPOINT, TODAY, trim=True) == "incremental"
    assert _times(read_datapoints(spark, path)) == [MIDNIGHT - 1, MIDNIGHT + 5 * DAY]


def test_ingest_after_a_broken_bootstrap(spark, tmp_path):
    """What a failed job left is no table: the window is taken, not the whole source."""
    path = tmp_path / "points"
    (path / "_temporary" / "0").mkdir(parents=True)
    source = _at(spark, [MIDNIGHT - 100 * DAY, MIDNIGHT - 89 * DAY, MIDNIGHT + 5 * DAY])
    assert I.ingest(source, str(path), DATAPOINT, TODAY, trim=True) == "bootstrap"
    assert _times(read_datapoints(spark, str(path))) == [MIDNIGHT - 89 * DAY]


def test_attributes_are_never_trimmed(spark, tmp_path):
    path = str(tmp_path / "attrs")
    rows = [(1, None, None, "x", MIDNIGHT - 80 * DAY), (2, None, None, "y", MIDNIGHT + 50 * DAY)]
    source = spark.createDataFrame(rows, ATTRIBUTE)
    for _ in range(2):
        I.ingest(source, path, ATTRIBUTE, TODAY, trim=False)
    assert spark.read.parquet(path).count() == 2


def test_stream_appends_landed_files_once(spark, tmp_path):
    landing, store, marks = (str(tmp_path / n) for n in ("landing", "store", "marks"))
    for times in ([MIDNIGHT, MIDNIGHT + 1], [MIDNIGHT + 2]):
        _at(spark, times).write.mode("append").parquet(landing)
        follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
    follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
    assert _times(read_datapoints(spark, store)) == [MIDNIGHT, MIDNIGHT + 1, MIDNIGHT + 2]


def test_stream_keeps_an_hour_that_lands_in_parts(spark, tmp_path):
    landing, store, marks = (str(tmp_path / n) for n in ("landing", "store", "marks"))
    for times in ([MIDNIGHT, MIDNIGHT + 5], [MIDNIGHT, MIDNIGHT + 5], [MIDNIGHT - DAY]):
        _at(spark, times).write.mode("append").parquet(landing)
        follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
    assert _times(read_datapoints(spark, store)) == [MIDNIGHT - DAY, MIDNIGHT, MIDNIGHT, MIDNIGHT + 5, MIDNIGHT + 5]


def test_stream_trims_on_request(spark, tmp_path):
    landing, store, marks = (str(tmp_path / n) for n in ("landing", "store", "marks"))
    _at(spark, [MIDNIGHT - 91 * DAY, MIDNIGHT - DAY, MIDNIGHT]).write.parquet(landing)
    follow(spark, landing, store, DATAPOINT, marks, trim=True).awaitTermination()
    assert _times(read_datapoints(spark, store)) == [MIDNIGHT - DAY, MIDNIGHT]


def _half(land):
    """`land`, but only the latest date gets there before it fails."""

    def run(df, schema, path, name):
        last = df.agg(F.max("time_stamp")).first()[0]
        land(df.where(F.col("time_stamp") == last), schema, path, name)
        raise OSError("cut off")

    return run


def test_repeated_batch_adds_what_is_missing(spark, tmp_path, monkeypatch):
    landing, store, marks = (str(tmp_path / n) for n in ("landing", "store", "marks"))
    times = [MIDNIGHT, MIDNIGHT + DAY, MIDNIGHT + 2 * DAY]
    _at(spark, times).write.parquet(landing)
    with monkeypatch.context() as m:
        m.setattr(increments, "land", _half(I.land))
        with pytest.raises(StreamingQueryException):
            follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
    assert _times(read_datapoints(spark, store)) == times[2:]
    for _ in range(2):
        follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
        assert _times(read_datapoints(spark, store)) == times


def test_night_after_a_half_done_append_adds_the_rest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    I.bootstrap(_at(spark, [MIDNIGHT - 1]), path, DATAPOINT, TODAY)
    times = [MIDNIGHT - 1, MIDNIGHT, MIDNIGHT + DAY, MIDNIGHT + 2 * DAY]
    with monkeypatch.context() as m:
        m.setattr(I, "land", _half(I.land))
        with pytest.raises(OSError):
            I.append_incremental(_at(spark, times), path, DATAPOINT)
    assert _times(read_datapoints(spark, path)) == [times[0], times[3]]
    assert I.stored_mark(spark, path, DATAPOINT) == times[0]
    more = [*times, times[3] + 1]  # the source has grown
    for _ in range(2):
        I.append_incremental(_at(spark, more), path, DATAPOINT)
        assert _times(read_datapoints(spark, path)) == more


def test_night_after_a_half_done_bootstrap_takes_the_window(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    times = [MIDNIGHT - 3 * DAY, MIDNIGHT - 2 * DAY, MIDNIGHT - 1]
    with monkeypatch.context() as m:
        m.setattr(I, "land", _half(I.land))
        with pytest.raises(OSError):
            I.ingest(_at(spark, times), path, DATAPOINT, TODAY, trim=True)
    assert I.ingest(_at(spark, times), path, DATAPOINT, TODAY, trim=True) == "bootstrap"
    assert _times(read_datapoints(spark, path)) == times
    assert I.ingest(_at(spark, times), path, DATAPOINT, TODAY, trim=True) == "incremental"
    assert _times(read_datapoints(spark, path)) == times


def test_append_to_nothing_takes_the_window(spark, tmp_path):
    path = str(tmp_path / "points")
    source = _at(spark, [MIDNIGHT - 91 * DAY, MIDNIGHT - DAY, MIDNIGHT])
    I.append_incremental(source.limit(0), path, DATAPOINT, TODAY)
    I.append_incremental(source, path, DATAPOINT, TODAY)
    assert _times(read_datapoints(spark, path)) == [MIDNIGHT - DAY]


def test_an_append_moves_no_stored_file(spark, tmp_path):
    path = tmp_path / "points"
    I.bootstrap(_at(spark, [MIDNIGHT - DAY, MIDNIGHT - 1]), str(path), DATAPOINT, TODAY)
    before = {f: f.stat().st_ino for f in path.rglob("part-*") if "_log" not in f.parts}
    I.append_incremental(_at(spark, [MIDNIGHT - 1, MIDNIGHT, MIDNIGHT + 5]), str(path), DATAPOINT)
    after = {f: f.stat().st_ino for f in path.rglob("part-*") if "_log" not in f.parts}
    assert len(after) > len(before) and before.items() <= after.items()


def test_night_and_stream_on_one_store(spark, tmp_path):
    landing, store, marks = (str(tmp_path / n) for n in ("landing", "store", "marks"))
    I.bootstrap(_at(spark, [MIDNIGHT - 1]), store, DATAPOINT, TODAY)
    _at(spark, [MIDNIGHT]).write.parquet(landing)
    follow(spark, landing, store, DATAPOINT, marks).awaitTermination()
    I.append_incremental(_at(spark, [MIDNIGHT - 1, MIDNIGHT, MIDNIGHT + 1]), store, DATAPOINT)
    assert _times(read_datapoints(spark, store)) == [MIDNIGHT - 1, MIDNIGHT, MIDNIGHT + 1]


def test_retention_of_a_boundary_date_of_several_appends(spark, tmp_path):
    path, mark = str(tmp_path / "points"), MIDNIGHT + 12 * 3_600_000
    floor = mark - 90 * DAY
    I._append(_at(spark, [floor - 5]), DATAPOINT, path)
    for t in (floor - 4, floor + 1, mark):
        I.append_incremental(_at(spark, [t]), path, DATAPOINT)
    I.retain(spark, path, DATAPOINT)
    assert _times(read_datapoints(spark, path)) == [floor + 1, mark]


def test_a_table_of_another_layout_is_refused(spark, tmp_path):
    path = str(tmp_path / "points")
    _at(spark, [MIDNIGHT]).withColumn("event_date", event_date("time_stamp")).write.partitionBy("event_date").parquet(path)
    assert _times(read_datapoints(spark, path)) == [MIDNIGHT]
    with pytest.raises(ValueError):
        I.append_incremental(_at(spark, [MIDNIGHT + 1]), path, DATAPOINT)


def test_csv_header_spaces_go_and_loads_append(spark, tmp_path):
    csv, table = str(tmp_path / "csv"), str(tmp_path / "table")
    spark.range(5).select(F.col("id").alias("time _stamp"), F.lit("x").alias(" app")).write.csv(csv, header=True)
    load_csv(spark, csv, table)
    loaded = load_csv(spark, csv, table)
    assert loaded.columns == ["time_stamp", "app"] and loaded.count() == 10
    assert dict(loaded.dtypes)["time_stamp"] == "int"


def test_sinks(spark, tmp_path):
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = spark.range(3)
    latest, history, replaced = (str(tmp_path / n) for n in ("latest", "history", "replaced"))
    assert not table_exists(spark, latest)
    for day in (day1, day2, day2):
        sinks.write_latest(rows, latest, day)
        sinks.write_history(rows, history, day)
        sinks.write_replace(rows, replaced)
    assert partitions(spark, latest, "run_date") == ["2024-01-02"]
    assert sinks.read_latest(spark, latest).count() == 3
    kept = spark.read.parquet(history)
    assert kept.count() == 6
    assert sorted(r.run_date for r in sinks.run_dates(kept).collect()) == [day1, day2]
    assert spark.read.parquet(replaced).count() == 3
    sinks.write_history(rows, history, day1, replace=True)
    assert partitions(spark, history, "run_date") == ["2024-01-01"]


def test_run_log_appends_minutes(spark, tmp_path):
    path = str(tmp_path / "log")
    assert sinks.read_run_log(spark, path).count() == 0
    sinks.log_run(spark, path, "p1", "30d", 90.0, TODAY)
    sinks.log_run(spark, path, "p2", "48h", 100_000.0, TODAY)
    got = {r.report: r.run_time for r in sinks.read_run_log(spark, path).collect()}
    assert got == {"p1": 1.5, "p2": 1666.67}


def test_a_night_writes_what_the_lazy_report_gives(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    points, attrs = event_points(spark, folder), event_attributes(spark, folder)
    base, date = str(tmp_path / "results"), dt.date(2024, 1, 31)
    for _ in range(2):
        run_night(spark, points, attrs, base, date, ["p9", "p10", "p6"], ["48h"], EVENT_APPS)
    assert sinks.read_run_log(spark, f"{base}/{RUN_LOG_TABLE}").count() == 6
    spec = REPORTS["p9"]
    lazy = report(points, attrs, spec, "48h", date, EVENT_APPS)
    for kind in ("data", "forecast", "valid", "analyse"):
        stored = spark.read.parquet(f"{base}/{spec.result_table(kind, '48h')}")
        want = lazy[kind]
        assert sorted(stored.columns) == sorted(want.columns)
        shared = [c for c in want.columns if c != "total_run_time"]
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes if c in shared]
        assert stored.select(*rounded).exceptAll(want.select(*rounded)).count() == 0
        assert stored.count() == want.count() > 0
    assert allow_apps(points, EVENT_APPS).count() < points.count()
    seen = monitor(spark, base, "48h")
    assert {r.report for r in seen.select("report").distinct().collect()} >= {"p9"}


def test_without_realtime_only_the_analysis_is_published(spark, tmp_path):
    folder, base = "/root/testdata/sf0.001", str(tmp_path / "results")
    points, attrs = event_points(spark, folder), event_attributes(spark, folder)
    run_night(spark, points, attrs, base, TODAY, ["p8"], ["48h"], EVENT_APPS, realtime=False)
    spec = REPORTS["p8"]
    found = {k: table_exists(spark, result_path(base, spec, k, "48h")) for k in ("data", "forecast", "valid", "analyse")}
    assert found == {"data": False, "forecast": False, "valid": False, "analyse": True}


def test_times_become_partition_bounds(spark, tmp_path):
    """A window, and what is retained, read only the folders of their dates."""
    path = str(tmp_path / "dated")
    points = event_points(spark, "/root/testdata/sf0.001")
    points.withColumn("event_date", event_date("time_stamp")).write.partitionBy("event_date").parquet(path)
    table = read_datapoints(spark, path)
    lo, hi = (I.midnight_ms(dt.date(2024, 1, d)) for d in (10, 12))

    def pruned(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters: ")[1:]]

    for closed in ("left", "right"):
        window = pull_window(table, lo, hi, closed)
        assert all("event_date" in p for p in pruned(window))
        assert window.count() == pull_window(points, lo, hi, closed).count() > 0
        assert {f.split("event_date=")[1][:10] for f in window.inputFiles()} >= {"2024-01-10", "2024-01-11"}
    kept = I.retained(table, 5)
    assert any("event_date" in p and "subquery" in p.lower() for p in pruned(kept))
    assert kept.count() == I.retained(points, 5).count() > 0
