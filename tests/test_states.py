"""States of months against the rows that they came from."""

import datetime as dt
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lagscope.operators import PeriodStates, last_rows, month_states, resample, unique_failures
from lagscope.plans import contracts, models
from lagscope.plans.periods import monthly_observations, yearly_at_year_end
from lagscope.registry import roles

D = dt.date
ROWS = [
    ("a", D(2020, 1, 1), Decimal("1.5")), ("a", D(2020, 1, 31), None), ("a", D(2020, 3, 2), Decimal("-7")),
    ("a", D(2020, 12, 31), Decimal("2")), ("a", D(2021, 1, 1), Decimal("0.000000001")), ("b", D(2020, 1, 15), Decimal("4")),
    ("b", D(2020, 2, 29), Decimal("5")), ("b", D(2020, 2, 29), Decimal("5")), ("b", D(2020, 2, 28), Decimal("1")),
    ("b", None, Decimal("9")), ("b", None, None), (None, D(2020, 1, 1), Decimal("3")), (None, D(2020, 1, 1), Decimal("3")),
]


@pytest.fixture(scope="module")
def staged(spark):
    df = spark.createDataFrame(ROWS, "k string, date date, value decimal(38,9)")
    return df.repartition(3).withColumn("other", F.col("value") * 2)


def states_of(df, keys=("k",)):
    frame = month_states(df, ["value", "other"], keys, total="value", checked=["date", "value"])
    return PeriodStates(frame, df, tuple(keys))


@pytest.mark.parametrize("grain", ["month", "quarter", "year"])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_last_rows_equal_those_of_the_rows(staged, rows, grain, keys):
    # Rows of one date are alike here, so that it does not matter which is taken.
    one = staged.filter("date IS NOT NULL")
    found = states_of(one, keys).last_rows(grain, ["value", "other"])
    expected = last_rows(one, grain, ["value", "other"], keys=keys)
    assert found.columns == expected.columns
    if keys:
        assert rows(found) == rows(expected)
    assert found.count() == expected.count()


@pytest.mark.parametrize("grain", ["quarter", "year"])
@pytest.mark.parametrize("rule", ["sum", "avg", "last"])
def test_totals_equal_those_of_the_rows(staged, rows, grain, rule):
    one = staged.filter("date IS NOT NULL")
    found = states_of(one).resample(grain, rule, "value", "out")
    expected = resample(one, grain, rule, "value", keys=["k"], out="out")
    assert found.schema["out"].dataType == expected.schema["out"].dataType
    assert rows(found) == rows(expected)


def test_averages_of_doubles(spark, rows):
    df = spark.createDataFrame([(D(2020, 1, d), float(d)) for d in range(1, 8)], "date date, value double")
    states = PeriodStates(month_states(df, ["value"], total="value"), df)
    assert rows(states.resample("year", "avg", "value", "value")) == [(2020, 4.0)]


def test_missing_values_and_rows(staged):
    states = states_of(staged)
    assert tuple(states.missing(["date", "value"]).first()) == (2, 2)
    assert states.row_count().first()[0] == len(ROWS)


def test_dates_that_repeat(staged, spark):
    states = states_of(staged)
    assert states.failing_dates() == 2
    assert {(r["k"], r["month_start"]) for r in states.repeated_days().collect()} == {("b", D(2020, 2, 1)), (None, D(2020, 1, 1))}
    exact = unique_failures(staged.filter("k IS NOT NULL"), "m", ["date"], ["k"]).first()["failures"]
    assert states_of(staged.filter("k IS NOT NULL")).failing_dates() == exact == 1
    # Without such months the rows are not read again.
    clean = states_of(staged.dropDuplicates(["k", "date"]))
    broken = PeriodStates(clean.frame, spark.range(1).select(F.raise_error(F.lit("read")).alias("date")), clean.keys)
    assert broken.failing_dates() == 0


def observations(spark, rows):
    raw = spark.createDataFrame(rows, "date string, value string")
    return raw.select(F.col("date").alias("realtime_start"), F.col("date").alias("realtime_end"), "date", "value")


def test_observations_with_and_without_repeated_months(spark, rows):
    once = [(f"20{y}-{m:02d}-01", str(y * m)) for y in range(10, 14) for m in range(1, 13)]
    for extra in ([], [("2012-05-17", "3"), ("2012-05-17", "3"), ("2013-12-24", "8"), (None, "1")]):
        raw = {"fred_inventories": observations(spark, once + extra)}
        states = models.share_states(raw)["fred_inventories"]
        assert states.single == (not extra)
        staged = models.stage("fred_inventories", raw["fred_inventories"])
        for make in (
            lambda s: monthly_observations(s, "inventory", "inventory"),
            lambda s: yearly_at_year_end(s, "yearly_inventory", "inventory_yoy"),
        ):
            assert rows(make(states)) == rows(make(staged))


@pytest.fixture
def raw(spark, tmp_path):
    """The five raw tables as files."""
    tables = {}
    for name, make in roles.RAW_TABLES.items():
        make(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    return tables


def test_each_raw_table_is_read_once(spark, raw, tmp_path, rows):
    """With the raw files gone, all models but the staged ones, and all checks, follow from
    the states."""
    expected = {name: rows(df) for name, df in models.build_models(raw).items() if not name.startswith("stg_")}
    checks = rows(models.run_checks(models.build_models(raw)))
    staged_plan = models._states_of("smh_prices", models.stage("smh_prices", raw["smh_prices"]), ())
    assert staged_plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    states = models.share_states(raw)
    for name in raw:
        shutil.rmtree(tmp_path / name)
    built = models.build_models(raw, states=states)
    assert {name: rows(df) for name, df in built.items() if not name.startswith("stg_")} == expected
    assert rows(models.run_checks(built, states=states)) == checks
    counted = {r["model"]: r["row_count"] for r in models.row_counts(built, states).collect()}
    assert set(counted) == {name for layer in models.MODEL_LAYERS.values() for name in layer}
    assert counted["int_smh_q"] == len(expected["int_smh_q"])


def test_one_scan_per_raw_table(spark, raw):
    """The job that makes the states scans five tables, and nothing else is read by it."""
    plans = []

    def watch(df, purpose, **metrics):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, purpose, **metrics)

    real, models.materialize_observed = models.materialize_observed, watch
    try:
        models.share_states(raw)
    finally:
        models.materialize_observed = real
    (text,) = plans
    assert text.count("FileScan") == 5 and "Join" not in text


def test_staged_checks_equal_those_over_the_rows(spark, rows):
    raw = {"fred_new_orders": roles.order_observations(spark, "/root/testdata/sf0.001")}
    staged = {"stg_fred_new_orders": models.stage("fred_new_orders", raw["fred_new_orders"])}
    states = models.share_states(raw)
    kinds = ("not_null", "unique")
    found = rows(models.run_checks(staged, kinds, states=states))
    assert found == rows(models.run_checks(staged, kinds)) and any(r[3] for r in found)
    assert {r[1] for r in found if r[2] == "not_null"} == set(contracts.NOT_NULL["stg_fred_new_orders"])


def test_no_rows(spark):
    raw = {"fred_new_orders": observations(spark, [("2020-01-01", "1")]).limit(0)}
    states = models.share_states(raw)["fred_new_orders"]
    assert states.single and states.failing_dates() == 0 and states.row_count().first()[0] == 0
    assert monthly_observations(states, "v", "v").count() == 0
