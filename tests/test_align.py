from datetime import date

from pyspark.sql import functions as F

from lagscope.operators import align_left, drop_latest, relative, spread_series, stack_series

BASE = [("2020-Q1", 1.0), ("2020-Q2", 2.0), ("2020-Q3", 3.0)]


def test_quarters_without_a_match_stay(spark, rows):
    base = spark.createDataFrame(BASE, "year_quarter string, smh double")
    other = spark.createDataFrame([("2020-Q2", 5.0), ("2021-Q1", 6.0)], "year_quarter string, sp500 double")
    found = align_left(base, [other], ["year_quarter"])
    assert rows(found) == [("2020-Q1", 1.0, None), ("2020-Q2", 2.0, 5.0), ("2020-Q3", 3.0, None)]
    beyond = found.select("year_quarter", relative("smh", "sp500"))
    assert rows(beyond) == [("2020-Q1", None), ("2020-Q2", -3.0), ("2020-Q3", None)]


def test_spreading_equals_joining(spark, rows):
    frames = {
        "a": spark.createDataFrame([(date(2020, 1, 1), 1.0), (date(2020, 2, 1), 2.0)], "date date, value double"),
        "b": spark.createDataFrame([(date(2020, 2, 1), 5.0)], "date date, value double"),
    }
    spread = spread_series(stack_series(frames), ["date"], {"a": {"value": "a"}, "b": {"value": "b"}})
    renamed = [df.withColumnRenamed("value", name) for name, df in frames.items()]
    assert rows(spread) == rows(align_left(renamed[0], renamed[1:], ["date"]))


def test_the_latest_period_is_dropped_by_data(spark, rows):
    df = spark.createDataFrame(BASE, "year_quarter string, smh double")
    assert [r[0] for r in rows(drop_latest(df, "year_quarter"))] == ["2020-Q1", "2020-Q2"]
    known = df.filter(F.col("smh") < 3)
    assert [r[0] for r in rows(drop_latest(known, "year_quarter"))] == ["2020-Q1"]
    assert rows(drop_latest(df.limit(0), "year_quarter")) == []


def test_the_latest_period_is_dropped_per_series(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 7), (None, 3), (None, 4)], "k string, p int")
    assert rows(drop_latest(df, "p", ["k"])) == [("a", 1), (None, 3)]
