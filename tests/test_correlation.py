import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.operators import (
    correlation,
    correlation_cells,
    lag_bank,
    lag_correlation,
    rank_by_strength,
    strongest_first,
    top_drivers,
    whole,
    whole_correlation,
)
from lagscope.operators.correlation import known


def corr(spark, pairs):
    df = spark.createDataFrame(pairs, "x double, y double")
    return df.agg(correlation(F.col("x"), F.col("y"))).first()[0]


def test_equals_numpy(spark):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=200), rng.normal(size=200)
    assert corr(spark, list(zip(x.tolist(), y.tolist()))) == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)


def test_only_complete_pairs_count(spark):
    pairs = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, 100.0), (100.0, None)]
    assert corr(spark, pairs) == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1], abs=1e-12)


@pytest.mark.parametrize(
    "pairs",
    [
        [(None, 1.0)],
        [(1.0, 1.0)],
        [(1.0, 2.0), (1.0, 3.0)],
        [(0.1, 0.3)] * 7 + [(0.1, 0.4)],
        [(1.0, 2.0), (2.0, 2.0), (3.0, None)],
    ],
    ids=["no pair", "one pair", "x constant", "x constant, inexact", "y constant over pairs"],
)
def test_undefined_is_null_and_no_error(spark, pairs):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert corr(spark, pairs) is None


def test_a_constant_put_together_from_many_tasks_does_not_vary(spark):
    df = spark.range(0, 1000, 1, 13).select(F.lit(0.1).alias("x"), F.col("id").cast("double").alias("y"))
    assert df.agg(correlation(F.col("x"), F.col("y"))).first()[0] is None


def test_bounded_by_one(spark):
    found = corr(spark, [(float(i), 3.0 * i + 1e6) for i in range(50)])
    assert abs(found) <= 1 + 1e-12 and found == pytest.approx(1.0)


LAGS = {"lag_1": 1, "lag_2": 2}
LABELS = {"lag_1": "Lag 1", "lag_2": "Lag 2"}
INDICATORS = {"a": "Indicator A", "b": "Indicator B"}


@pytest.fixture
def fact(spark):
    rng = np.random.default_rng(3)
    data = [
        (k, q, *(float(v) if v > -1.2 else None for v in rng.normal(size=3))) for k in ("k1", "k2") for q in range(15)
    ]
    return spark.createDataFrame(data, "k string, q int, target double, a double, b double")


def matrix(fact, keys=()):
    bank = lag_bank(fact, INDICATORS, LAGS, ["q"], ["target"], keys)
    return lag_correlation(bank, "target", LAGS, keys)


def test_lagged_correlation_equals_numpy(fact):
    one = fact.filter("k = 'k1'")
    data = one.orderBy("q").toPandas()
    for row in matrix(one).collect():
        column = {label: c for c, label in INDICATORS.items()}[row["indicator"]]
        for lag, n in LAGS.items():
            pairs = data[["target"]].assign(y=data[column].shift(n)).dropna()
            expected = np.corrcoef(pairs["target"].astype(float), pairs["y"].astype(float))[0, 1]
            assert row[lag] == pytest.approx(expected, abs=1e-12)


def test_a_panel_equals_its_series_one_by_one(fact, rows):
    panel = matrix(fact, ["k"])
    for k in ("k1", "k2"):
        ours = panel.filter(F.col("k") == k).drop("k")
        single = matrix(fact.filter(F.col("k") == k))
        rounded = [F.round(c, 9).alias(c) for c in LAGS]
        assert rows(ours.select("indicator", *rounded)) == rows(single.select("indicator", *rounded))


def test_an_indicator_without_values_keeps_its_row(fact):
    found = matrix(fact.withColumn("b", F.lit(None).cast("double")))
    assert {r["indicator"]: r["lag_1"] is None for r in found.collect()} == {"Indicator A": False, "Indicator B": True}


def test_empty_cells_are_kept_as_rows_but_not_ranked(spark, rows):
    df = spark.createDataFrame([("A", 0.5, None), ("B", -0.7, 0.5)], "indicator string, lag_1 double, lag_2 double")
    cells = correlation_cells(df, LABELS)
    assert cells.count() == 4
    ranked = rank_by_strength(cells).orderBy("rank").collect()
    assert [(r["indicator"], r["lag_period"], r["rank"]) for r in ranked] == [
        ("B", "Lag 1", 1),
        ("A", "Lag 1", 2),
        ("B", "Lag 2", 3),
    ]
    as_array = df.agg(strongest_first(LABELS).alias("cells")).first()["cells"]
    assert [(c["indicator"], c["lag_period"]) for c in as_array] == [(r["indicator"], r["lag_period"]) for r in ranked]
    top = [(r["indicator"], r["lag_period"]) for r in top_drivers(cells, 2).collect()]
    assert top == [("B", "Lag 1"), ("A", "Lag 1")]


def test_equal_strength_is_ordered_by_name(spark):
    data = [("B", "Lag 1", 0.5), ("A", "Lag 2", -0.5), ("A", "Lag 1", 0.5 + 1e-9)]
    cells = spark.createDataFrame(data, "indicator string, lag_period string, correlation double")
    ranked = rank_by_strength(cells).orderBy("rank").collect()
    assert [(r["indicator"], r["lag_period"]) for r in ranked] == [("A", "Lag 1"), ("A", "Lag 2"), ("B", "Lag 1")]


def test_nan_is_no_value_and_never_ranks(spark, rows):
    nan = float("nan")
    pairs = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (nan, 4.0), (4.0, nan), (nan, nan)]
    df = spark.createDataFrame(pairs, "x double, y double")
    found = df.agg(correlation(F.col("x"), F.col("y"))).first()[0]
    assert found == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1])
    cells = spark.createDataFrame(
        [("a", "Lag 1Y", nan), ("b", "Lag 1Y", 0.5000001), ("c", "Lag 1Y", -0.5000004), ("d", "Lag 1Y", None)],
        "indicator string, lag_period string, correlation double",
    )
    assert [r["indicator"] for r in rank_by_strength(cells).orderBy("rank").collect()] == ["c", "b"]
    assert [r["indicator"] for r in top_drivers(cells, 3).collect()] == ["c", "b"]


def whole_corr(df):
    top = {c: df.agg(F.max(F.abs(known(F.col(c))))).first()[0] for c in ("x", "y")}
    x, y = (whole(known(F.col(c)), F.lit(top[c])) for c in ("x", "y"))
    return df.agg(whole_correlation(x, y)).first()[0]


@pytest.mark.parametrize("scale", [1e-200, 1e-3, 1.0, 1e200])
def test_whole_numbers_correlate_as_doubles_do(spark, scale):
    rng = np.random.default_rng(11)
    x = rng.normal(size=300)
    y = x * 0.3 + rng.normal(size=300)
    df = spark.createDataFrame([(float(a * scale), float(b / scale)) for a, b in zip(x, y)], "x double, y double")
    assert whole_corr(df) == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-10)


def test_the_same_bits_under_any_partitioning(spark):
    rng = np.random.default_rng(12)
    rows = [("k", i, float(rng.normal() * 10.0 ** rng.integers(-3, 6)), float(rng.normal())) for i in range(3000)]
    df = spark.createDataFrame(rows, "indicator string, i int, target double, lag_1 double")
    found = set()
    for n in (1, 3, 7):
        dealt = df.repartition(n, "i").withColumn("lag_2", F.col("lag_1") * 2)
        found |= {tuple(r) for r in lag_correlation(dealt, "target", LAGS).collect()}
    assert len(found) == 1


@pytest.mark.parametrize("sign", [1, -1])
def test_collinear_pairs_do_not_leave_the_bounds(spark, sign):
    for n in (2, 3, 50):
        df = spark.createDataFrame([(0.1 * i, sign * (0.3 * i + 7.7)) for i in range(n)], "x double, y double")
        assert -1 <= whole_corr(df) <= 1
        assert whole_corr(df) == pytest.approx(sign, abs=1e-11)


@pytest.mark.parametrize(
    "pairs",
    [[(None, 1.0)], [(1.0, 1.0)], [(0.0, 1.0), (0.0, 2.0)], [(0.1, 0.3)] * 7 + [(0.1, 0.4)], [(float("nan"), 2.0), (2.0, 2.0)]],
)
def test_undefined_over_whole_numbers_is_null(spark, pairs):
    assert whole_corr(spark.createDataFrame(pairs, "x double, y double")) is None
