from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.plans import build_models, fact_from_series, key_kpi, kpi_from_fact, publish, quarterly_fact
from lagscope.plans.marts import FACT_COLUMNS, correlation_matrix
from lagscope.plans.models import MODEL_LAYERS, run_checks
from lagscope.plans.periods import monthly_returns
from lagscope.plans.staging import stage_last_prices
from lagscope.sources import RAW_OBSERVATIONS, RAW_PRICES

# Output columns of the models.
PRICES = ["date", "open", "high", "low", "close", "adjusted_close", "volume"]
OBSERVATIONS = ["realtime_start", "realtime_end", "date", "value"]
PERIOD = ["year", "quarter", "year_quarter"]
COLUMNS = {
    "stg_smh_prices": PRICES,
    "stg_sp500_prices": PRICES,
    "stg_fred_inventories": OBSERVATIONS,
    "stg_fred_new_orders": OBSERVATIONS,
    "stg_fred_semiconductor_ppi": OBSERVATIONS,
    "int_smh_prices": [*PRICES, "month", "monthly_return"],
    "int_sp500_prices": [*PRICES, "month", "monthly_return"],
    "int_fred_inventories": ["date", "month", "inventory", "inventory_yoy", "inventory_mom"],
    "int_fred_new_orders": ["date", "month", "new_orders", "new_orders_yoy", "new_orders_mom"],
    "int_fred_semiconductor_ppi": ["date", "month", "semiconductor_ppi", "ppi_yoy", "ppi_mom"],
    "int_smh_q": ["date", *PERIOD, "smh_value", "smh_qoq", "smh_yoy"],
    "int_sp500_q": ["date", *PERIOD, "sp500_value", "sp500_qoq", "sp500_yoy"],
    "int_fred_inventories_q": ["date", *PERIOD, "quarterly_inventory", "inventory_qoq", "inventory_yoy"],
    "int_fred_new_orders_q": [*PERIOD, "new_orders", "new_orders_qoq", "new_orders_yoy"],
    "int_fred_ppi_q": [*PERIOD, "semiconductor_ppi", "ppi_qoq", "ppi_yoy"],
    "int_smh_yearly": ["year", "date", "adjusted_close", "yearly_return"],
    "int_sp500_yearly": ["year", "date", "adjusted_close", "yearly_return"],
    "int_fred_inventories_yearly": ["date", "year", "yearly_inventory", "inventory_yoy"],
    "int_fred_new_orders_yearly": ["year", "new_orders", "new_orders_yoy"],
    "int_fred_ppi_yearly": ["year", "semiconductor_ppi", "ppi_yoy"],
    "fct_smh_q": [
        "date", *PERIOD, "smh_value", "smh_qoq", "smh_yoy", "sp500_value", "sp500_qoq", "sp500_yoy",
        "smh_vs_sp500_qoq", "smh_vs_sp500_yoy", "new_orders", "new_orders_qoq", "new_orders_yoy",
        "semiconductor_ppi", "ppi_qoq", "ppi_yoy", "quarterly_inventory", "inventory_qoq", "inventory_yoy",
    ],
    "fct_smh_q_correlation": ["indicator", "lag_1_year", "lag_2_year", "lag_3_year", "lag_4_year", "lag_5_year"],
    "fct_key_kpi": [
        "date", *PERIOD, "smh_return_yoy", "smh_vs_sp500_yoy", "top_reversal_driver", "top_reversal_driver_corr",
        "top_margin_driver", "top_margin_driver_corr",
    ],
}

FIRST, DAYS = date(2010, 1, 1), 365 * 9 + 40


@pytest.fixture(scope="module")
def raw(spark):
    """Nine years and a bit of daily prices and monthly observations, with faults."""
    rng = np.random.default_rng(11)

    def prices(start):
        walk = start * np.exp(np.cumsum(rng.normal(0, 0.02, DAYS)))
        nanos = [int((FIRST + timedelta(days=i) - date(1970, 1, 1)).days) * 86_400 * 10**9 for i in range(DAYS)]
        data = [(n + 52_200 * 10**9, *[float(v)] * 5, float(i)) for i, (n, v) in enumerate(zip(nanos, walk))]
        return spark.createDataFrame(data, RAW_PRICES)

    def observations(faulty):
        months = [date(2010 + i // 12, i % 12 + 1, 1) for i in range(109)]
        values = ["." if faulty and i == 30 else f"{v:.4f}" for i, v in enumerate(100 + rng.normal(0, 5, 109))]
        data = [("2024-05-01", "2024-05-01", str(m), v) for m, v in zip(months, values)]
        return spark.createDataFrame(data, RAW_OBSERVATIONS)

    return {
        "smh_prices": prices(50.0),
        "sp500_prices": prices(1000.0),
        "fred_inventories": observations(True),
        "fred_new_orders": observations(False),
        "fred_semiconductor_ppi": observations(False),
    }


@pytest.fixture(scope="module")
def models(raw):
    return build_models(raw)


def test_all_models_have_their_columns(models):
    assert {name: df.columns for name, df in models.items()} == COLUMNS
    assert sorted(models) == sorted(m for layer in MODEL_LAYERS.values() for m in layer)


def test_prices_picked_before_they_are_typed(spark, raw, models, rows):
    found = monthly_returns(stage_last_prices(raw["smh_prices"], "month"))
    assert found.columns == models["int_smh_prices"].columns
    assert rows(found) == rows(models["int_smh_prices"])
    panel = raw["smh_prices"].withColumn("k", F.lit("a")).unionByName(raw["sp500_prices"].withColumn("k", F.lit("b")))
    panel = monthly_returns(stage_last_prices(panel, "month", ["k"]), ["k"])
    assert rows(panel.filter("k = 'b'").drop("k")) == rows(models["int_sp500_prices"])


def test_fact_of_many_targets_that_share_the_rest(models, rows):
    target = models["int_smh_q"]
    panel = target.withColumn("k", F.lit("a")).unionByName(
        target.withColumn("smh_yoy", F.col("smh_yoy") + 1).withColumn("k", F.lit("b"))
    )
    others = [models[f"int_{n}_q"] for n in ("sp500", "fred_new_orders", "fred_ppi", "fred_inventories")]
    fact = quarterly_fact(panel, *others, keys=["k"], shared_keys=[])
    assert rows(fact.filter("k = 'a'").drop("k")) == rows(models["fct_smh_q"])
    keyed = [df.withColumn("k", F.lit("a")) for df in others]
    fact = quarterly_fact(target.withColumn("k", F.lit("a")), *keyed, keys=["k"])
    assert rows(fact.drop("k")) == rows(models["fct_smh_q"])


def test_only_what_is_asked_for_is_built(raw):
    stored = []

    def store(df, name):
        stored.append(name)
        return df

    assert list(build_models(raw, store, ["int_smh_q", "stg_smh_prices"])) == ["stg_smh_prices", "int_smh_q"]
    assert stored == []
    assert list(build_models(raw, store, ["fct_smh_q"])) == ["fct_smh_q"]


def test_fact_equals_pandas(raw, models):
    smh = models["stg_smh_prices"].toPandas().sort_values("date")
    smh["period"] = smh["date"].map(lambda d: f"{d.year}-Q{(d.month + 2) // 3}")
    last = smh.groupby("period").last()["adjusted_close"].astype(float)
    yoy = (last / last.shift(4) - 1) * 100
    fact = models["fct_smh_q"].toPandas().set_index("year_quarter")["smh_yoy"]
    expected = yoy.dropna().iloc[:-1]
    assert list(fact.sort_index().index) == list(expected.index)
    assert np.allclose(fact.sort_index(), expected, atol=1e-9)


def test_correlations_equal_pandas(models):
    fact = models["fct_smh_q"].toPandas().sort_values(["year", "quarter"])
    columns = {"New Orders YoY": "new_orders_yoy", "PPI YoY": "ppi_yoy", "Inventory YoY": "inventory_yoy"}
    for row in models["fct_smh_q_correlation"].collect():
        for years in range(1, 6):
            earlier = fact[columns[row["indicator"]]].shift(4 * years)
            expected = fact["smh_vs_sp500_yoy"].corr(earlier)
            assert row[f"lag_{years}_year"] == pytest.approx(expected, abs=1e-9)


def test_headline_row(models):
    (row,) = models["fct_key_kpi"].collect()
    cells = [
        (abs(r[f"lag_{y}_year"]), f"{r['indicator']} Lag {y}Y", r[f"lag_{y}_year"])
        for r in models["fct_smh_q_correlation"].collect()
        for y in range(1, 6)
    ]
    (_, first, first_corr), (_, second, second_corr) = sorted(cells, reverse=True)[:2]
    assert (row["top_reversal_driver"], row["top_reversal_driver_corr"]) == (first, first_corr)
    assert (row["top_margin_driver"], row["top_margin_driver_corr"]) == (second, second_corr)
    latest = models["fct_smh_q"].orderBy(F.desc("date")).first()
    assert (row["date"], row["smh_return_yoy"]) == (latest["date"], latest["smh_yoy"])


def test_stacked_fact_equals_joined_fact(models):
    stacked = [
        models[f"stg_{table}"].select(F.lit(name).alias("series_id"), "date", F.col(column).alias("value"))
        for table, name, column in (
            ("smh_prices", "smh", "adjusted_close"),
            ("sp500_prices", "sp500", "adjusted_close"),
            ("fred_new_orders", "new_orders", "value"),
            ("fred_semiconductor_ppi", "semiconductor_ppi", "value"),
            ("fred_inventories", "inventory", "value"),
        )
    ]
    series = stacked[0]
    for df in stacked[1:]:
        series = series.unionByName(df)

    def rounded(df):
        kinds = dict(df.dtypes)
        columns = [
            F.round(F.col(c).cast("double"), 9).alias(c) if kinds[c][:3] in ("dou", "dec") else F.col(c)
            for c in FACT_COLUMNS
        ]
        return sorted(tuple(r) for r in df.select(columns).toPandas().fillna("none").itertuples(index=False))

    assert rounded(fact_from_series(series)) == rounded(models["fct_smh_q"])


def test_headline_in_one_pass_equals_headline_from_tables(models, rows):
    fact = models["fct_smh_q"]
    one_pass = kpi_from_fact(fact)
    assert one_pass.columns == models["fct_key_kpi"].columns
    rounded = [
        F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in models["fct_key_kpi"].dtypes
    ]
    assert rows(one_pass.select(rounded)) == rows(models["fct_key_kpi"].select(rounded))


def test_headline_without_correlations_is_one_row_without_drivers(models):
    unknown = F.lit(None).cast("double")
    fact = models["fct_smh_q"].withColumns(dict.fromkeys(("new_orders_yoy", "ppi_yoy", "inventory_yoy"), unknown))
    for kpi in (kpi_from_fact(fact), key_kpi(fact, correlation_matrix(fact))):
        (row,) = kpi.collect()
        assert row["smh_return_yoy"] is not None
        assert row["top_reversal_driver"] is None and row["top_margin_driver_corr"] is None


def test_headline_of_an_empty_fact_is_empty(models):
    fact = models["fct_smh_q"].limit(0)
    assert kpi_from_fact(fact).collect() == []
    assert key_kpi(fact, correlation_matrix(fact)).collect() == []


def test_checks_find_the_missing_observation(models):
    failures = {(r["model"], r["column"], r["check"]): r["failures"] for r in run_checks(models).collect()}
    assert len(failures) == 96 + 33 + 3 + 1
    found = {k: n for k, n in failures.items() if n}
    assert found == {
        ("stg_fred_inventories", "value", "not_null"): 1,
        ("int_fred_inventories", "inventory", "not_null"): 1,
    }


def test_publish_makes_views_and_tables(spark, raw, tmp_path):
    for _ in range(2):  # a refresh of what is there
        publish(spark, raw, str(tmp_path))
    tables = {t.name: t.isTemporary for t in spark.catalog.listTables()}
    for layer, names in MODEL_LAYERS.items():
        for name in names:
            assert tables[name] == (layer != "mart")
    found = spark.sql("select k.year_quarter from fct_key_kpi k join fct_smh_q using (year_quarter)").collect()
    assert len(found) == 1
