"""Exact quantiles against pandas, with hot values and hot groups."""

import numpy as np
import pandas as pd
import pytest

from trafficcast.functions import quantiles
from trafficcast.functions.quantiles import exact_quantiles
from trafficcast.operators.explore import correlations, summary

PROBS = [0.0, 0.25, 0.5, 0.75, 0.98, 1.0]


def _check(spark, frame, groups, probs):
    got = exact_quantiles(spark.createDataFrame(frame), groups, "v", probs).toPandas()
    parts = frame.groupby(groups[0]) if groups else [(None, frame)]
    for key, part in parts:
        mine = got if key is None else got[got[groups[0]] == key]
        mine = mine.set_index("prob")["quantile"]
        assert len(mine) == len(probs)
        for p in probs:
            assert mine[p] == pytest.approx(part.v.quantile(p), rel=1e-12)


def test_hot_value_and_hot_group(spark):
    rng = np.random.default_rng(0)
    v = np.exp(rng.normal(0, 4, 60_000))
    v[rng.random(60_000) < 0.4] = 5.0
    g = np.where(rng.random(60_000) < 0.4, 0, rng.integers(1, 20, 60_000))
    _check(spark, pd.DataFrame({"g": g, "v": v}), ["g"], PROBS)


@pytest.mark.parametrize("ranked, steps", [(1, 8), (40, 16)])
@pytest.mark.parametrize("kind", ["smooth", "ties", "tails", "tiny"])
def test_brackets_shrink_to_what_is_wanted(spark, monkeypatch, ranked, steps, kind):
    rng = np.random.default_rng(3)
    v = {
        "smooth": rng.normal(0, 1, 300),
        "ties": rng.integers(0, 12, 300).astype(float),
        "tails": np.exp(rng.normal(0, 3, 300)),
        "tiny": 1 + rng.integers(0, 50, 300) * 2.0**-52,
    }[kind]
    monkeypatch.setattr(quantiles, "RANKED", ranked)
    monkeypatch.setattr(quantiles, "STEPS", steps)
    # A wide bracket, so that there is something to shrink.
    monkeypatch.setattr(quantiles, "_MARGIN", 0.3)
    most = []
    count = quantiles._most
    monkeypatch.setattr(quantiles, "_most", lambda *a: most.append(count(*a)) or most[-1])
    frame = pd.DataFrame({"g": np.where(np.arange(300) % 3 == 0, 1, 2), "v": v})
    _check(spark, frame, ["g"], [0.0, 0.77])
    assert most[-1] <= ranked and len(most) < 12


def test_no_window_ranks_a_whole_group(spark):
    """A group 100 times as large hands hardly more rows to the ranking task."""

    def inside(n):
        frame = spark.range(n).selectExpr("0 AS g", "cast(pmod(xxhash64(id), 1000000007) AS double) AS v")
        sizes = []
        count = quantiles._most
        quantiles._most = lambda *a: sizes.append(count(*a)) or sizes[-1]
        try:
            quantiles.exact_quantiles(frame, ["g"], "v", [0.5]).collect()
        finally:
            quantiles._most = count
        return sizes[-1]

    assert inside(2_000_000) <= max(quantiles.RANKED / 50, 100 * inside(20_000) / 5)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
@pytest.mark.parametrize("probs", [[0.25], [0.1], [0.98], PROBS])
def test_small_groups(spark, n, probs):
    _check(spark, pd.DataFrame({"v": np.arange(n, dtype=float) ** 2}), [], probs)


def test_summary_is_describe(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"a": rng.normal(size=500), "b": rng.integers(0, 9, 500)})
    got = summary(spark.createDataFrame(frame), [], ["a", "b"]).toPandas().set_index("column")
    want = frame.describe().T
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for column in ("a", "b"):
        for stat in want.columns:
            assert got.loc[column, names.get(stat, stat)] == pytest.approx(want.loc[column, stat])


def test_correlations_are_whole(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("xyz"))
    got = correlations(spark.createDataFrame(frame), list("xyz")).toPandas()
    table = got.pivot(index="column_a", columns="column_b", values="corr")
    assert np.allclose(table.to_numpy(), frame.corr().to_numpy())
    assert len(got) == 9
