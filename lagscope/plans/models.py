"""The 23 named outputs, wired from the operators.

Staged and resampled models are lazy frames; the marts are stored tables that later
models read back.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.operators import PeriodStates, failures_from_states, failures_in_one_pass, month_states
from lagscope.plans import contracts
from lagscope.plans.marts import correlation_matrix, key_kpi, quarterly_fact
from lagscope.plans.periods import (
    PRICE_COLUMNS,
    Source,
    monthly_observations,
    monthly_prices,
    quarterly,
    yearly,
    yearly_at_year_end,
)
from lagscope.plans.staging import stage_observations, stage_prices
from lagscope.sources import materialize, materialize_observed, refresh_table, store_buckets

# The raw tables and the models by layer.
RAW_PRICE_TABLES = ["smh_prices", "sp500_prices"]
RAW_OBSERVATION_TABLES = ["fred_inventories", "fred_new_orders", "fred_semiconductor_ppi"]
MODEL_LAYERS = {
    "staging": [
        "stg_fred_inventories",
        "stg_fred_new_orders",
        "stg_fred_semiconductor_ppi",
        "stg_smh_prices",
        "stg_sp500_prices",
    ],
    "intermediate": [
        "int_fred_inventories",
        "int_fred_new_orders",
        "int_fred_semiconductor_ppi",
        "int_smh_prices",
        "int_sp500_prices",
        "int_smh_q",
        "int_sp500_q",
        "int_fred_inventories_q",
        "int_fred_new_orders_q",
        "int_fred_ppi_q",
        "int_smh_yearly",
        "int_sp500_yearly",
        "int_fred_inventories_yearly",
        "int_fred_new_orders_yearly",
        "int_fred_ppi_yearly",
    ],
    "mart": ["fct_smh_q", "fct_smh_q_correlation", "fct_key_kpi"],
}

# How the files of a stored table are sorted.
TABLE_ORDER = {"fct_smh_q": ["year", "quarter"], "fct_smh_q_correlation": ["indicator"]}

# The resampled models that the fact is made from, in the order it takes them.
FACT_INPUTS = ["int_smh_q", "int_sp500_q", "int_fred_new_orders_q", "int_fred_ppi_q", "int_fred_inventories_q"]

CONTRACTS = {
    "not_null": contracts.NOT_NULL,
    "unique": contracts.UNIQUE,
    "grain": contracts.GRAIN,
    "row_count": contracts.ROW_COUNT,
}

Store = Callable[[DataFrame, str], DataFrame]


def stage(table: str, raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The staged model of one raw table."""
    if table in RAW_PRICE_TABLES:
        return stage_prices(raw, keys)
    if table in RAW_OBSERVATION_TABLES:
        return stage_observations(raw, keys)
    raise ValueError(f"unknown raw table {table!r}")


def _states_of(table: str, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    checked = contracts.NOT_NULL[f"stg_{table}"]
    if table in RAW_PRICE_TABLES:
        return month_states(staged, PRICE_COLUMNS, keys, checked=checked)
    return month_states(staged, ["value"], keys, total="value", checked=checked)


def stacked_states(raw: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """States of the months of several raw tables, each read once, by ``series_id``."""
    states = [
        _states_of(table, stage(table, df, keys), keys).withColumn("series_id", F.lit(table)) for table, df in raw.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)


def share_states(raw: Mapping[str, DataFrame], keys: Sequence[str] = (), tables: Collection[str] | None = None) -> dict[str, PeriodStates]:
    """States of the months of every raw table, from one job that reads each table once.

    All resampled models and the checks of the staged ones follow from them. ``tables`` names
    those that are needed. The most rows of a month are observed as the states are written.
    """
    raw = {table: df for table, df in raw.items() if tables is None or table in tables}
    most = {f"most_{table}": F.max(F.when(F.col("series_id") == table, F.col("rows"))) for table in raw}
    stored, found = materialize_observed(stacked_states(raw, keys), "period_states", **most)
    return {
        table: PeriodStates(
            stored.filter(F.col("series_id") == table).drop("series_id"), stage(table, df, keys), tuple(keys),
            (found.get(f"most_{table}") or 0) <= 1,
        )
        for table, df in raw.items()
    }


# Resampled models: the raw table each comes from, and how it is made from its staged rows or
# from the states of its months.
INTERMEDIATE: dict[str, tuple[str, Callable[[Source, Sequence[str]], DataFrame]]] = {
    "int_fred_inventories": (
        "fred_inventories",
        lambda df, keys=(): monthly_observations(df, "inventory", "inventory", keys),
    ),
    "int_fred_new_orders": (
        "fred_new_orders",
        lambda df, keys=(): monthly_observations(df, "new_orders", "new_orders", keys),
    ),
    "int_fred_semiconductor_ppi": (
        "fred_semiconductor_ppi",
        lambda df, keys=(): monthly_observations(df, "semiconductor_ppi", "ppi", keys),
    ),
    "int_smh_prices": ("smh_prices", monthly_prices),
    "int_sp500_prices": ("sp500_prices", monthly_prices),
    "int_smh_q": (
        "smh_prices",
        lambda df, keys=(): quarterly(df, "last", "adjusted_close", "smh_value", "smh", keys),
    ),
    "int_sp500_q": (
        "sp500_prices",
        lambda df, keys=(): quarterly(df, "last", "adjusted_close", "sp500_value", "sp500", keys),
    ),
    "int_fred_inventories_q": (
        "fred_inventories",
        lambda df, keys=(): quarterly(df, "last", "value", "quarterly_inventory", "inventory", keys),
    ),
    "int_fred_new_orders_q": (
        "fred_new_orders",
        lambda df, keys=(): quarterly(df, "sum", "value", "new_orders", "new_orders", keys),
    ),
    "int_fred_ppi_q": (
        "fred_semiconductor_ppi",
        lambda df, keys=(): quarterly(df, "avg", "value", "semiconductor_ppi", "ppi", keys),
    ),
    "int_smh_yearly": (
        "smh_prices",
        lambda df, keys=(): yearly(df, "last", "adjusted_close", "adjusted_close", "yearly_return", keys),
    ),
    "int_sp500_yearly": (
        "sp500_prices",
        lambda df, keys=(): yearly(df, "last", "adjusted_close", "adjusted_close", "yearly_return", keys),
    ),
    "int_fred_inventories_yearly": (
        "fred_inventories",
        lambda df, keys=(): yearly_at_year_end(df, "yearly_inventory", "inventory_yoy", keys),
    ),
    "int_fred_new_orders_yearly": (
        "fred_new_orders",
        lambda df, keys=(): yearly(df, "sum", "value", "new_orders", "new_orders_yoy", keys),
    ),
    "int_fred_ppi_yearly": (
        "fred_semiconductor_ppi",
        lambda df, keys=(): yearly(df, "avg", "value", "semiconductor_ppi", "ppi_yoy", keys),
    ),
}


def intermediate_model(name: str, sources: Mapping[str, Source], keys: Sequence[str] = ()) -> DataFrame:
    """One resampled model from the staged rows, or the states, of each raw table."""
    table, make = INTERMEDIATE[name]
    return make(sources[table], keys)


def build_marts(intermediate: Mapping[str, DataFrame], store: Store, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """``store`` keeps a frame under a name and returns the stored one."""
    fact = store(quarterly_fact(*(intermediate[name] for name in FACT_INPUTS), keys=keys), "fct_smh_q")
    matrix = store(correlation_matrix(fact, keys), "fct_smh_q_correlation")
    return {
        "fct_smh_q": fact,
        "fct_smh_q_correlation": matrix,
        "fct_key_kpi": store(key_kpi(fact, matrix, keys), "fct_key_kpi"),
    }


def fact_from_buckets(
    intermediate: Mapping[str, DataFrame], root: str, keys: Sequence[str], buckets: int, prefix: str = "bucketed_"
) -> DataFrame:
    """The fact of a panel whose five quarterly series are stored in buckets of series and
    quarter: the four joins read matching buckets and shuffle nothing. For series that are
    joined more often than they are written."""
    on = [*keys, "year_quarter"]
    stored = (store_buckets(intermediate[name], prefix + name, root, on, buckets) for name in FACT_INPUTS)
    return quarterly_fact(*stored, keys=keys)


def build_models(
    raw: Mapping[str, DataFrame],
    store: Store = materialize,
    names: Collection[str] | None = None,
    keys: Sequence[str] = (),
    states: Mapping[str, PeriodStates] | None = None,
) -> dict[str, DataFrame]:
    """Models by name from the five raw tables: all 23, or ``names`` with what they need.

    With ``keys``, every raw table holds them and many series, all built in one go. Raw tables
    are read once each, for ``states``; those made before may be given.
    """
    marts = set(MODEL_LAYERS["mart"])
    wanted = {name for layer in MODEL_LAYERS.values() for name in layer} if names is None else set(names)
    with_marts = bool(wanted & marts)
    staged = {f"stg_{table}": stage(table, df, keys) for table, df in raw.items()}
    resampled = [name for name in INTERMEDIATE if name in wanted or (with_marts and name in FACT_INPUTS)]
    if resampled and states is None:
        states = share_states(raw, keys, {INTERMEDIATE[name][0] for name in resampled})
    intermediate = {name: intermediate_model(name, states, keys) for name in resampled}
    models = {**staged, **intermediate, **(build_marts(intermediate, store, keys) if with_marts else {})}
    return {name: df for name, df in models.items() if name in wanted}


def publish(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, keys: Sequence[str] = (), prefix: str = "",
    states: Mapping[str, PeriodStates] | None = None,
) -> dict[str, DataFrame]:
    """Full refresh: staging and intermediate models as views, marts as catalog tables under
    ``root``, their names after ``prefix``. With ``keys``, a panel as one refresh.

    Views of resampled models read the states of this refresh, so they agree with its marts.
    """

    def store(df: DataFrame, name: str) -> DataFrame:
        refresh_table(df, prefix + name, root, [*keys, *TABLE_ORDER.get(name, ())])
        return spark.table(prefix + name)

    models = build_models(raw, store, keys=keys, states=states)
    for layer in ("staging", "intermediate"):
        for name in MODEL_LAYERS[layer]:
            models[name].createOrReplaceTempView(prefix + name)
    return models


def row_counts(models: Mapping[str, DataFrame], states: Mapping[str, PeriodStates]) -> DataFrame:
    """(model, row_count): of staged models from the states of their months."""
    counts = []
    for name, df in models.items():
        table = name.removeprefix("stg_")
        counted = states[table].row_count() if table in states else df.agg(F.count(F.lit(1)).alias("row_count"))
        counts.append(counted.select(F.lit(name).alias("model"), "row_count"))
    return reduce(DataFrame.unionByName, counts)


def declared_models(kinds: Collection[str]) -> set[str]:
    """The models that declare any check of these kinds."""
    return {name for kind in kinds for name in CONTRACTS[kind]}


def run_checks(
    models: Mapping[str, DataFrame],
    kinds: Collection[str] = tuple(CONTRACTS),
    keys: Sequence[str] = (),
    states: Mapping[str, PeriodStates] | None = None,
) -> DataFrame:
    """Every declared check of the models given, as (model, column, check, failures). Each
    model is read once for all of its checks; a staged one whose ``states`` are given is not
    read again.

    With ``keys``, models hold many series, and values must be unique within each.
    """
    results = []
    for name, df in models.items():
        declared = {
            "not_null": contracts.NOT_NULL.get(name, ()) if "not_null" in kinds else (),
            "unique": contracts.UNIQUE.get(name, ()) if "unique" in kinds else (),
            "grain": contracts.GRAIN.get(name, ()) if "grain" in kinds else (),
            "rows": contracts.ROW_COUNT.get(name) if "row_count" in kinds and not keys else None,
        }
        table = name.removeprefix("stg_")
        if table != name and table in (states or {}):
            results += failures_from_states(states[table], name, declared["not_null"], declared["unique"])
        elif any(value is not None and value != () for value in declared.values()):
            results.append(failures_in_one_pass(df, name, *declared.values(), keys=keys))
    return reduce(DataFrame.union, results)
