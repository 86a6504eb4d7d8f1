"""The quarterly fact, its lag correlations and the headline row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.functions import PERIOD_COLUMNS, quarter_label
from lagscope.operators import (
    align_left,
    correlation_cells,
    driver_columns,
    drop_latest,
    lag_bank,
    lag_correlation,
    latest_rows,
    nth_driver_columns,
    rank_by_strength,
    relative,
    resample_by_rule,
    spread_series,
    strongest_first,
    with_changes,
)
from lagscope.plans.periods import QUARTERS_BACK

PERIOD = PERIOD_COLUMNS["quarter"]
PERIOD_ORDER = ["year", "quarter"]

# How each series is resampled, and its columns in the fact.
SERIES_RULES = {
    "smh": "last",
    "sp500": "last",
    "new_orders": "sum",
    "semiconductor_ppi": "avg",
    "inventory": "last",
}
SERIES_COLUMNS = {
    "smh": ["smh_value", "smh_qoq", "smh_yoy"],
    "sp500": ["sp500_value", "sp500_qoq", "sp500_yoy"],
    "new_orders": ["new_orders", "new_orders_qoq", "new_orders_yoy"],
    "semiconductor_ppi": ["semiconductor_ppi", "ppi_qoq", "ppi_yoy"],
    "inventory": ["quarterly_inventory", "inventory_qoq", "inventory_yoy"],
}
RELATIVE_COLUMNS = ["smh_vs_sp500_qoq", "smh_vs_sp500_yoy"]
TARGET = "smh_vs_sp500_yoy"
INDICATORS = {
    "new_orders_yoy": "New Orders YoY",
    "ppi_yoy": "PPI YoY",
    "inventory_yoy": "Inventory YoY",
}
LAGS = {"lag_1_year": 4, "lag_2_year": 8, "lag_3_year": 12, "lag_4_year": 16, "lag_5_year": 20}
LAG_LABELS = {
    "lag_1_year": "Lag 1Y",
    "lag_2_year": "Lag 2Y",
    "lag_3_year": "Lag 3Y",
    "lag_4_year": "Lag 4Y",
    "lag_5_year": "Lag 5Y",
}
DRIVERS = {1: "top_reversal_driver", 2: "top_margin_driver"}

FACT_COLUMNS = [
    "date",
    *PERIOD,
    *SERIES_COLUMNS["smh"],
    *SERIES_COLUMNS["sp500"],
    *RELATIVE_COLUMNS,
    *SERIES_COLUMNS["new_orders"],
    *SERIES_COLUMNS["semiconductor_ppi"],
    *SERIES_COLUMNS["inventory"],
]


def _finish_fact(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quarters with both returns known, but for the latest of those: it may be unfinished."""
    known = wide.filter(F.col("smh_qoq").isNotNull() & F.col("smh_yoy").isNotNull())
    whole = drop_latest(known, "year_quarter", keys)
    return whole.withColumns(
        {
            "smh_vs_sp500_qoq": relative("smh_qoq", "sp500_qoq"),
            "smh_vs_sp500_yoy": relative("smh_yoy", "sp500_yoy"),
        }
    ).select(*keys, *FACT_COLUMNS)


def quarterly_fact(
    smh: DataFrame,
    sp500: DataFrame,
    new_orders: DataFrame,
    ppi: DataFrame,
    inventories: DataFrame,
    keys: Sequence[str] = (),
    shared_keys: Sequence[str] | None = None,
) -> DataFrame:
    """The fact from five quarterly series.

    ``shared_keys`` are the keys that the other four carry, where the target has one
    series per ``keys`` and they do not.
    """
    on = [*(keys if shared_keys is None else shared_keys), "year_quarter"]
    sides = zip(
        (sp500, new_orders, ppi, inventories),
        ("sp500", "new_orders", "semiconductor_ppi", "inventory"),
        strict=True,
    )
    others = [df.select(*on, *SERIES_COLUMNS[name]) for df, name in sides]
    return _finish_fact(align_left(smh, others, on), keys)


def quarter_changes(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stacked observations to stacked quarters with value, qoq and yoy."""
    quarters = resample_by_rule(series, "quarter", SERIES_RULES, keys=keys)
    return with_changes(quarters, "value", QUARTERS_BACK, PERIOD_ORDER, [*keys, "series_id"])


def spread_quarters(changes: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Stacked quarters to one row per quarter, with the fact's columns of ``names``."""
    columns = {
        name: dict(zip(["value", *QUARTERS_BACK], SERIES_COLUMNS[name], strict=True)) for name in names
    }
    if "smh" in columns:
        columns["smh"]["date"] = "date"
    return spread_series(changes, [*keys, *PERIOD_ORDER], columns)


def fact_from_series(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The fact from stacked observations (series_id, date, value).

    Same rows as ``quarterly_fact``, with one aggregation, one window and one regrouping
    for all five series in place of one each and four joins.
    """
    wide = spread_quarters(quarter_changes(series, keys), list(SERIES_RULES), keys)
    labelled = wide.withColumn("year_quarter", quarter_label(F.col("year"), F.col("quarter")))
    return _finish_fact(labelled, keys)


def fact_with_shared(target: DataFrame, shared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fact of many targets that share one benchmark and one set of indicators.

    ``target`` holds one row per ``keys`` and quarter with the target's columns,
    ``shared`` the stacked quarters of the other series. Those are spread to one row per
    quarter here, so what is broadcast has at most four rows a year however many targets
    and raw rows there are.
    """
    names = [name for name in SERIES_COLUMNS if name != "smh"]
    aligned = target.join(F.broadcast(spread_quarters(shared, names)), PERIOD_ORDER, "left")
    labelled = aligned.withColumn("year_quarter", quarter_label(F.col("year"), F.col("quarter")))
    return _finish_fact(labelled, keys)


def lagged_indicators(fact: DataFrame, keys: Sequence[str] = (), keep: Sequence[str] = (TARGET,)) -> DataFrame:
    """The fact per indicator with its values one to five years of rows before."""
    return lag_bank(fact, INDICATORS, LAGS, PERIOD_ORDER, keep, keys)


def correlation_matrix(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of relative performance with each indicator at each lag."""
    return lag_correlation(lagged_indicators(fact, keys), TARGET, LAGS, keys)


def cells(matrix: DataFrame, keys: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    return correlation_cells(matrix, LAG_LABELS, [*keys, *keep])


def _kpi_columns(names: Mapping[int, str]) -> list[str]:
    return [c for name in names.values() for c in (name, f"{name}_corr")]


def key_kpi(fact: DataFrame, matrix: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The latest quarter beside the two strongest drivers, from the two stored tables.

    The drivers are one scalar subquery, or one row per series; without any correlation
    they are NULL.
    """
    ranked = rank_by_strength(cells(matrix, keys), keys)
    if keys:
        drivers = ranked.groupBy(*keys).agg(*driver_columns(DRIVERS))
        latest = latest_rows(fact, keys=keys).join(drivers, list(keys), "left")
        return latest.select(
            *keys, "date", *PERIOD, F.col("smh_yoy").alias("smh_return_yoy"), TARGET, *_kpi_columns(DRIVERS)
        )
    picked = ranked.agg(*driver_columns(DRIVERS))
    drivers = picked.select(F.struct(*_kpi_columns(DRIVERS))).scalar()
    latest = latest_rows(fact).select(
        "date", *PERIOD, F.col("smh_yoy").alias("smh_return_yoy"), TARGET, drivers.alias("_drivers")
    )
    return latest.select("date", *PERIOD, "smh_return_yoy", TARGET, "_drivers.*")


def kpi_from_fact(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``key_kpi`` in one pass over a fact that is not stored, one row per ``keys``.

    Every indicator's group holds all quarters of the series, so the latest quarter is
    picked up by the aggregation that correlates, and the fact is computed once. The date,
    which says the quarter, and the two returns keep that a hash aggregation.
    """
    headline = ["date", "smh_yoy", TARGET]
    latest = [F.max_by(c, "date").alias(f"_{c}") for c in headline]
    matrix = lag_correlation(lagged_indicators(fact, keys, headline), TARGET, LAGS, keys, latest)
    strongest = matrix.groupBy(*keys).agg(
        *(F.max(f"_{c}").alias(c) for c in headline), strongest_first(LAG_LABELS).alias("_cells")
    )
    year, quarter = F.year("date").cast("bigint"), F.quarter("date").cast("bigint")
    return strongest.filter(F.col("date").isNotNull()).select(
        *keys,
        "date",
        year.alias("year"),
        quarter.alias("quarter"),
        quarter_label(year, quarter).alias("year_quarter"),
        F.col("smh_yoy").alias("smh_return_yoy"),
        TARGET,
        *nth_driver_columns(F.col("_cells"), DRIVERS),
    )
