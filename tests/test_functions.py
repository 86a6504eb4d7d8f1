from datetime import date

import pytest
from pyspark.sql import functions as F

from lagscope.functions import (
    epoch_nanos_to_date,
    month_label,
    percent_change,
    quarter_label,
    row_order,
    safe_bigint,
    safe_date,
    safe_decimal,
)


def one(spark, values, kind, make):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_dates_that_cannot_be_read_are_null(spark):
    texts = ["2024-01-31", "2024-1-5", "abc", "2024", "2024-02-30", "", None, "2024-01-31 10:00"]
    expected = [date(2024, 1, 31), date(2024, 1, 5)] + [None] * 6
    assert one(spark, texts, "string", safe_date) == expected


def test_numbers_that_cannot_be_read_are_null(spark):
    found = one(spark, ["12.5", ".", "", "abc", None, "1e3", "-0.0000000005"], "string", safe_decimal)
    assert [None if v is None else float(v) for v in found] == [12.5, None, None, None, None, 1000.0, -1e-9]
    found = one(spark, [1.5, float("nan"), float("inf"), 1e40], "double", safe_decimal)
    assert [None if v is None else float(v) for v in found] == [1.5, None, None, None]


def test_decimal_keeps_nine_digits(spark):
    df = spark.createDataFrame([("1",)], "x string").select(safe_decimal(F.col("x")).alias("x"))
    assert df.schema["x"].dataType.simpleString() == "decimal(38,9)"


def test_whole_numbers_round_half_away_from_zero(spark):
    found = one(spark, [2.5, -2.5, 2.4, 3.5, float("nan"), 1e30, None], "double", safe_bigint)
    assert found == [3, -3, 2, 4, None, None, None]
    assert one(spark, [7], "bigint", safe_bigint) == [7]


def test_nanoseconds_to_utc_day(spark):
    nanos = [1704205800000000000, 1704153599999999999, 1704153600000000000, -1000, None]
    expected = [date(2024, 1, 2), date(2024, 1, 1), date(2024, 1, 2), date(1969, 12, 31), None]
    assert one(spark, nanos, "bigint", epoch_nanos_to_date) == expected


def test_the_day_does_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, [1704153600000000000], "bigint", epoch_nanos_to_date) == [date(2024, 1, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_percent_change(spark):
    df = spark.createDataFrame([(7.0, 3.0), (5.0, 0.0), (None, 1.0), (1.0, None)], "a double, b double")
    found = [r[0] for r in df.select(percent_change(F.col("a"), F.col("b"))).collect()]
    assert found == [pytest.approx(133.33333333333334, abs=1e-12), None, None, None]


def test_percent_change_of_decimals_keeps_its_digits(spark):
    df = spark.sql("select cast(7 as decimal(38,9)) a, cast(3 as decimal(38,9)) b")
    assert df.select(percent_change(F.col("a"), F.col("b"))).first()[0] == pytest.approx(133.33333333333334, abs=1e-12)


def test_labels(spark):
    df = spark.sql("select date'2024-02-29' d, 2024L y, 1L q")
    row = df.select(month_label(F.col("d")), quarter_label(F.col("y"), F.col("q"))).first()
    assert tuple(row) == ("2024-02", "2024-Q1")


def test_row_order_goes_by_date_then_repeats(spark):
    dates = [None, date(1, 1, 1), date(1969, 1, 1), date(2024, 1, 1), date(9999, 12, 31)]
    df = spark.createDataFrame([(d, float(9 - i)) for i, d in enumerate(dates)], "d date, v double")
    orders = [r[0] for r in df.select(row_order(F.col("d"), [F.col("v")])).collect()]
    assert orders == sorted(orders) and len(set(orders)) == 5
