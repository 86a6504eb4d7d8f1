from datetime import date

from lagscope.operators import (
    failures_in_one_pass,
    grain_failures,
    load_report,
    not_null_failures,
    row_count_failures,
    unique_failures,
)
from lagscope.plans import contracts
from lagscope.plans.models import MODEL_LAYERS


def test_missing_and_repeated_values_are_counted(spark, rows):
    data = [(date(2024, 1, 1), "a", 1.0), (date(2024, 1, 1), "b", None), (None, "b", 2.0), (None, "b", 3.0)]
    df = spark.createDataFrame(data, "date date, k string, v double")
    assert rows(not_null_failures(df, "m", ["date", "k", "v"])) == [
        ("m", "date", "not_null", 2),
        ("m", "k", "not_null", 0),
        ("m", "v", "not_null", 1),
    ]
    assert rows(unique_failures(df, "m", ["date", "k", "v"])) == [
        ("m", "date", "unique", 1),
        ("m", "k", "unique", 1),
        ("m", "v", "unique", 0),
    ]
    assert rows(grain_failures(df, "m", ["date", "k"])) == [("m", "date, k", "grain", 1)]


def test_values_may_repeat_in_another_series(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1), (None, 1), ("c", 2)], "k string, d int")
    assert rows(unique_failures(df, "m", ["d"], ["k"])) == [("m", "d", "unique", 2)]
    assert rows(unique_failures(df, "m", ["d"])) == [("m", "d", "unique", 1)]


def test_an_empty_frame_passes(spark, rows):
    df = spark.createDataFrame([], "date date")
    assert rows(not_null_failures(df, "m", ["date"])) == [("m", "date", "not_null", 0)]
    assert rows(unique_failures(df, "m", ["date"])) == [("m", "date", "unique", 0)]
    assert rows(row_count_failures(df, "m", 1)) == [("m", "*", "row_count", 1)]


def test_not_null_reads_the_frame_once(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    plan = not_null_failures(df, "m", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_load_report(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    assert rows(load_report(df, "t")) == [("t", "a", "bigint", 2), ("t", "b", "string", 2)]


def test_every_declared_check_is_there():
    assert sum(len(c) for c in contracts.NOT_NULL.values()) == 96
    assert sum(len(c) for c in contracts.UNIQUE.values()) == 33
    models = {m for layer in MODEL_LAYERS.values() for m in layer}
    assert len(models) == 23
    assert {*contracts.NOT_NULL, *contracts.UNIQUE, *contracts.GRAIN} == models


def test_one_pass_equals_the_checks_one_by_one(spark, rows):
    data = [("a", 1, "x"), ("a", 1, None), ("b", 1, "x"), ("b", None, "y,z"), (None, 2, "y"), (None, 2, "y")]
    df = spark.createDataFrame(data, "k string, d int, v string")
    one_by_one = (
        not_null_failures(df, "m", ["d", "v"])
        .union(unique_failures(df, "m", ["d", "v"], ["k"]))
        .union(grain_failures(df, "m", ["k", "d"]))
        .union(row_count_failures(df, "m", 4))
    )
    together = failures_in_one_pass(df, "m", ["d", "v"], ["d", "v"], ["d"], 4, ["k"])
    assert rows(together) == rows(one_by_one)
    assert rows(failures_in_one_pass(df.limit(0), "m", ["d"], ["d"], ["d"], 1)) == [
        ("m", "*", "row_count", 1), ("m", "d", "grain", 0), ("m", "d", "not_null", 0), ("m", "d", "unique", 0),
    ]
    text = together._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Scan") == 1
