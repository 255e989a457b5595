"""Every query with SQL must agree with it, row for row; the others must run."""

import math
import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# Fits 200 rounds of trees; test_models.py runs it with fewer.
SLOW = {"boosted_forecast"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS FROM '{SF_DIR}/{file}'")
    return con


@pytest.fixture(scope="module")
def results(spark, request):
    """Futures of the chosen queries; small ones run several at once."""
    chosen = {
        item.callspec.params["name"]: None
        for item in request.session.items
        if item.fspath == request.fspath and hasattr(item, "callspec")
    }
    with ThreadPoolExecutor(4) as pool:
        yield {n: pool.submit(lambda n=n: QUERIES[n](spark, SF_DIR).toPandas()) for n in chosen}


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, float) else str(v)


def _rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(_cell, row)) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(results, duck, name):
    ours = results[name].result()
    theirs = duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(results, name):
    assert len(results[name].result().columns) > 0


def test_entry_gives_the_hours_ahead(spark):
    rows = contract.entry(spark).toPandas()
    assert rows.groupby("source").size().eq(48).all() and len(rows) > 0
