"""All pairs of targets and indicators, tile by tile."""

import math

import numpy as np
import pytest

from lagscope.operators import pair_correlations, strongest_pairs

LAGS = {"L0": 0, "L1": 1, "L3": 3}


def series(seed, n, periods, gaps=0.2):
    """n series of a random walk's steps, some values missing."""
    random = np.random.default_rng(seed)
    values = random.normal(size=(n, periods))
    values[random.random(values.shape) < gaps] = np.nan
    return values


def frame(spark, values, name):
    rows = [
        (i, p, None if np.isnan(v) else float(v)) for i, own in enumerate(values.tolist()) for p, v in enumerate(own, 100)
    ]
    return spark.createDataFrame(rows, f"{name} long, period int, {name}_value double").repartition(5)


def plain(y, x, lags=LAGS):
    found = {}
    for i, a in enumerate(y):
        for j, b in enumerate(x):
            for name, lag in lags.items():
                u, v = a[lag:], b[: len(b) - lag]
                both = ~np.isnan(u) & ~np.isnan(v)
                u, v = u[both], v[both]
                if len(u) > 1 and u.min() < u.max() and v.min() < v.max():
                    found[i, j, name] = float(np.corrcoef(u, v)[0, 1])
    return found


def pairs(spark, y, x, **more):
    return pair_correlations(frame(spark, y, "t"), frame(spark, x, "i"), LAGS, "t", "i", "period", "t_value", "i_value", **more)


@pytest.mark.parametrize("tile", [1000, 7])
def test_equals_numpy(spark, tile):
    y, x = series(1, 23, 30), series(2, 17, 30)
    y[3], x[4], y[5, 2:] = 2.5, np.nan, np.nan
    expected = plain(y, x)
    found = {(r["t"], r["i"], r["lag_period"]): r["correlation"] for r in pairs(spark, y, x, tile=tile).collect()}
    assert set(found) == set(expected)
    assert all(math.isclose(found[k], expected[k], abs_tol=1e-9) for k in expected)


def test_the_strongest_equal_the_full_sort(spark):
    y, x = series(3, 40, 25), series(4, 30, 25)
    y[7] = y[8] = x[9]
    cells = pairs(spark, y, x, tile=16).collect()
    expected = sorted(cells, key=lambda r: (-abs(round(r["correlation"], 12)), r["t"], r["i"], r["lag_period"]))[:20]
    few = pairs(spark, y, x, tile=16, most=20)
    assert few.count() < len(cells)
    found = sorted(strongest_pairs(few, 20, "t", "i").collect(), key=lambda r: r["rank"])
    assert [tuple(r)[:3] for r in found] == [tuple(r)[:3] for r in expected]
    assert [r["rank"] for r in found] == list(range(1, 21))


def test_a_large_panel_sends_rows_per_tile_not_per_pair(spark):
    """A thousand by a thousand series: no join, and each series goes to a row or a column of tiles."""
    y, x = series(5, 1000, 24, 0), series(6, 1000, 24, 0)
    found = pairs(spark, y, x)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("FlatMapGroupsInArrow") == 1
    assert found.count() == 3 * 1000 * 1000


def test_odd_series(spark):
    rows = [(None, 1, 1.0), (None, 2, 3.0), (None, 3, float("nan")), (5, 1, 1.0), (5, 2, 2.0), (5, None, 9.0), (6, 1, None)]
    t = spark.createDataFrame(rows, "t long, period int, t_value double")
    i = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 1.0), ("b", 1, 1.0), ("b", 2, 1.0)], "i string, period int, i_value double")

    def run(a, b):
        return pair_correlations(a, b, {"now": 0, "far": 50}, "t", "i", "period", "t_value", "i_value")

    assert sorted((tuple(r) for r in run(t, i).collect()), key=repr) == [(5, "a", "now", -1.0), (None, "a", "now", -1.0)]
    assert run(t.limit(0), i).count() == run(t, i.limit(0)).count() == run(t.limit(0), i.limit(0)).count() == 0
    assert strongest_pairs(run(t, i), 1, "t", "i").first()["t"] == 5
