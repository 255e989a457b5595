"""The base grain, the one scan of a night, and the join with the locations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trafficcast.operators import series as S
from trafficcast.operators.grain import base_grain
from trafficcast.plans import nightly
from trafficcast.plans.reports import REPORTS, hourly, hourly_of_grain
from trafficcast.sources.adapters import EVENT_APPS, event_attributes, event_points

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def odd_points(spark):
    """Events with nulls and zeros in every measure and key."""
    points = event_points(spark, SMALL)
    n = F.pmod(F.xxhash64("target_address", "time_stamp", "application"), F.lit(11))
    return points.withColumns(
        {
            "app_rsp_time": F.when(n == 0, None).when(n == 1, 0.0).otherwise(F.col("app_rsp_time")),
            "byte_count": F.when(n == 2, None).when(n == 3, 0).otherwise(F.col("byte_count")),
            "target_attribute_id": F.when(n != 4, F.col("target_attribute_id")),
            "target_address": F.when(n != 5, F.col("target_address")),
            "source": F.when(n != 6, F.col("source")),
        }
    )


@pytest.fixture(scope="module")
def attributes(spark):
    """Several locations for some ids, pairs that repeat, an id without location."""
    one = event_attributes(spark, SMALL)
    more = one.filter("attribute_id % 5 = 0").withColumn("location", F.lit("elsewhere"))
    none = one.filter("attribute_id = 3").withColumn("location", F.lit(None).cast("string"))
    return one.unionByName(more).unionByName(one.filter("attribute_id < 4")).unionByName(none)


@pytest.mark.parametrize("report", list(REPORTS))
def test_series_from_the_grain_are_those_of_the_points(odd_points, attributes, report):
    direct = hourly(odd_points, attributes, REPORTS[report], EVENT_APPS)
    rolled = hourly_of_grain(base_grain(odd_points), S.locations(attributes), REPORTS[report], EVENT_APPS)
    keyed = lambda df: df.na.fill("-").na.fill(-1)
    assert _rows(keyed(direct)) == _rows(keyed(rolled))


@pytest.mark.parametrize("report", ["p6", "p7"])
def test_a_large_dimension_gives_the_same(odd_points, attributes, report, monkeypatch):
    keyed = lambda df: df.na.fill("-")
    small = _rows(keyed(hourly(odd_points, attributes, REPORTS[report], EVENT_APPS)))
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    assert _rows(keyed(hourly(odd_points, attributes, REPORTS[report], EVENT_APPS))) == small


def test_a_small_dimension_is_broadcast_and_moves_no_measurement(odd_points, attributes, monkeypatch):
    places = S.locations(attributes)
    rows = odd_points.select("target_attribute_id", "target_address", "time_stamp")
    plan = _plan(S.with_locations(rows, places, S.fits(places)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(target_attribute_id#" not in plan.split("BroadcastExchange")[0]
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    salted = S.with_locations(rows, places, S.fits(places))
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_a_night_reads_the_measurements_once(spark, tmp_path, monkeypatch):
    points = event_points(spark, SMALL)
    plans, written = [], nightly._written

    def seen(df, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, path)

    monkeypatch.setattr(nightly, "_written", seen)
    nightly.run_night(
        spark, points, event_attributes(spark, SMALL), str(tmp_path / "night"), dt.date(2024, 1, 31),
        horizons=["48h"], apps=EVENT_APPS,
    )
    reading = [p for p in plans if "props" in p or "event_type" in p]
    assert len(plans) > 9 and len(reading) == 1 and reading[0].count("Relation") == 1


def test_a_denylist_reaches_the_night(spark, tmp_path):
    base, points = str(tmp_path / "denied"), event_points(spark, SMALL)
    denied = points.select("source").filter("source = 's1'").distinct()
    nightly.run_night(
        spark, points, event_attributes(spark, SMALL), base, dt.date(2024, 1, 31),
        reports=["p8", "p9", "p10"], horizons=["48h"], apps=EVENT_APPS, denylist=denied,
    )
    for report in ("p8", "p9"):
        found = spark.read.parquet(nightly.result_path(base, REPORTS[report], "data", "48h")).select("source").distinct()
        assert sorted(r.source for r in found.collect()) == ["s0", "s2", "s3"]
