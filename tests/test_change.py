from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lagscope.operators import with_changes, with_changes_any_length, with_lags, with_lags_any_length
from lagscope.operators.long_series import with_positions
from lagscope.plans.periods import monthly_observations, yearly_at_year_end


def test_a_lag_counts_rows_where_a_month_is_missing(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (4, 30.0)], "month int, v double")
    found = with_changes(df, "v", {"mom": 1}, ["month"]).orderBy("month").collect()
    assert [r["mom"] for r in found] == [None, 100.0, pytest.approx(50.0)]


def test_zero_divisor_and_missing_values_give_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, 5.0)], "m int, v double")
    assert [r["c"] for r in with_changes(df, "v", {"c": 1}, ["m"]).orderBy("m").collect()] == [None] * 4


def test_all_changes_share_one_window(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "k string, m int, v double")
    changed = with_changes(df, "v", {"a": 1, "b": 4, "c": 12}, ["m"], ["k"])
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


def test_a_panel_equals_its_series_one_by_one(spark, rows):
    data = [(k, m, float(m * n)) for n, k in enumerate("abc", 1) for m in range(1, 20)]
    df = spark.createDataFrame(data, "k string, m int, v double")
    panel = with_changes(df, "v", {"c": 12}, ["m"], ["k"])
    for k in "abc":
        single = with_changes(df.filter(F.col("k") == k), "v", {"c": 12}, ["m"])
        assert rows(panel.filter(F.col("k") == k)) == rows(single)


def test_monthly_observations(spark):
    data = [(date(2020 + i // 12, i % 12 + 1, 1), float(100 + i)) for i in range(14)]
    staged = spark.createDataFrame(data, "date date, value double")
    found = monthly_observations(staged, "inventory", "inventory").orderBy("date").collect()
    assert found[0].asDict() == {
        "date": date(2020, 1, 1), "month": "2020-01", "inventory": 100.0, "inventory_yoy": None, "inventory_mom": None,
    }
    assert found[12]["inventory_yoy"] == pytest.approx(12.0)
    assert found[13]["inventory_mom"] == pytest.approx((113 / 112 - 1) * 100)


def test_monthly_observations_whose_dates_repeat(spark, rows):
    data = [(k, date(2020, i % 5 + 1, 1), float(i * 37 % 101)) for k in "ab" for i in range(200)]
    staged = spark.createDataFrame(data, "k string, date date, v2 double").repartition(5)
    plain = with_changes(staged.select("k", "date", "v2"), "v2", {"v_yoy": 12, "v_mom": 1}, ["date", "v2"], ["k"])
    found = monthly_observations(staged.withColumnRenamed("v2", "value"), "v", "v", ["k"])
    assert rows(found.select("k", "date", "v", "v_yoy", "v_mom")) == rows(plain)


def test_rows_that_the_order_does_not_tell_apart_are_split(spark):
    same = spark.range(0, 4000, 1, 4).select(F.lit("a").alias("k"), F.lit(1).alias("date"), F.lit(2.0).alias("v"))
    found = with_changes_any_length(same, "v", {"c": 1}, ["date", "v"], ["k"], block=100)
    assert found.filter("c is null").count() == 1
    assert found.filter("c = 0").count() == 3999
    # Small reads, so that each sorted file is a task of its own.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "2k"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sorted_rows = with_positions(same, ["k", "date", "v"])
        assert sorted_rows.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_year_without_december_has_no_row(spark, rows):
    staged = spark.createDataFrame(
        [(date(2020, 12, 1), 10.0), (date(2021, 11, 1), 11.0), (date(2022, 12, 1), 15.0)], "date date, value double"
    )
    assert rows(yearly_at_year_end(staged, "v", "c")) == [
        (date(2020, 12, 1), 2020, 10.0, None),
        (date(2022, 12, 1), 2022, 15.0, 50.0),
    ]


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows in one series, and many of them on one day."""
    n = F.col("id")
    few = F.when(n % 50 != 0, F.concat(F.lit("s"), (n % 7).cast("string")))
    days = F.when(n < 1500, 0).otherwise(n % 9).cast("int")
    return spark.range(0, 3000, 1, 6).select(
        F.when(n % 3 < 2, "hot").otherwise(few).alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), days).alias("date"),
        n.alias("n"),
        F.when(n % 11 != 0, F.pmod(n * 7919, F.lit(1000)).cast("double")).alias("v"),
    )


@pytest.mark.parametrize("block", [1, 12, 64, 100_000])
def test_lags_over_long_series_equal_a_plain_window(skewed, rows, block):
    lags = {"one": 1, "twelve": 12}
    plain = with_lags(skewed, "v", lags, ["date", "n"], ["k"])
    long = with_lags_any_length(skewed, "v", lags, ["date", "n"], ["k"], block=block)
    assert rows(long) == rows(plain)


def test_lags_over_one_long_series(skewed, rows):
    lags = {"four": 4}
    plain = with_lags(skewed, "v", lags, ["date", "n"])
    assert rows(with_lags_any_length(skewed, "v", lags, ["date", "n"], block=10)) == rows(plain)


def test_positions_number_all_rows(skewed):
    found = with_positions(skewed, ["k", "date", "n"])
    expected = skewed.withColumn("expected", F.row_number().over(Window.orderBy("k", "date", "n")) - 1)
    joined = found.join(expected.select("n", "expected"), "n")
    assert joined.filter(F.col("position") != F.col("expected")).count() == 0
    assert joined.count() == 3000


def test_no_task_holds_more_than_a_block_and_its_reach(skewed):
    long = with_lags_any_length(skewed, "v", {"twelve": 12}, ["date", "n"], ["k"], block=100)
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_block" in plan
