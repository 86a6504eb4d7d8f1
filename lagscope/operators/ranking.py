"""Rank (indicator, lag) pairs and pick the strongest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagscope.operators.long_series import with_positions

# Correlations that agree to this many digits count as equal and are ordered by name,
# since further digits depend on the order in which tasks add up.
RANK_DIGITS = 12


def _known() -> Column:
    return F.col("correlation").isNotNull() & ~F.isnan("correlation")


def _strength() -> list[Column]:
    return [
        F.abs(F.round("correlation", RANK_DIGITS)).desc(),
        F.col("indicator").asc(),
        F.col("lag_period").asc(),
    ]


def rank_by_strength(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Known correlations numbered from the strongest, either sign, per series.

    A series has as many cells as there are indicators and lags; to number the cells of
    all series together use ``rank_overall``.
    """
    window = Window.partitionBy(*keys).orderBy(*_strength())
    return cells.filter(_known()).withColumn(
        "rank", F.row_number().over(window).cast("bigint")
    )


def rank_overall(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Known correlations of all series numbered together, by a sort over all tasks."""
    known = cells.filter(_known())
    weakest_last = known.withColumn("_strength", -F.abs(F.round("correlation", RANK_DIGITS)))
    numbered = with_positions(weakest_last, ["_strength", "indicator", "lag_period", *keys])
    return numbered.select(*cells.columns, (F.col("position") + 1).alias("rank"))


def top_drivers(cells: DataFrame, k: int) -> DataFrame:
    """The k strongest pairs of all; no task sees more than its own rows and k of each other."""
    return cells.filter(_known()).orderBy(*_strength()).limit(k)


def driver_columns(names: Mapping[int, str]) -> list[Column]:
    """Aggregates over ranked cells: for each rank a label and its correlation."""
    label = F.concat("indicator", F.lit(" "), "lag_period")
    columns = []
    for rank, name in names.items():
        columns.append(F.max(F.when(F.col("rank") == rank, label)).alias(name))
        columns.append(F.max(F.when(F.col("rank") == rank, F.col("correlation"))).alias(f"{name}_corr"))
    return columns


def strongest_first(labels: Mapping[str, str]) -> Column:
    """Aggregate over a matrix: its known cells as an array in the order of their rank.

    The array holds one element per indicator and lag. ``labels`` maps lag column to the
    text shown for it.
    """
    cells = F.array(
        *(
            F.struct(
                (-F.abs(F.round(lag, RANK_DIGITS))).alias("weakness"),
                F.col("indicator"),
                F.lit(text).alias("lag_period"),
                F.col(lag).alias("correlation"),
            )
            for lag, text in labels.items()
        )
    )
    known = F.filter(cells, lambda cell: cell["correlation"].isNotNull() & ~F.isnan(cell["correlation"]))
    return F.sort_array(F.flatten(F.collect_list(known)))


def nth_driver_columns(ranked: Column, names: Mapping[int, str]) -> list[Column]:
    """As ``driver_columns``, from the array of ``strongest_first``."""
    columns = []
    for rank, name in names.items():
        cell = F.get(ranked, F.lit(rank - 1))
        columns.append(F.concat(cell["indicator"], F.lit(" "), cell["lag_period"]).alias(name))
        columns.append(cell["correlation"].alias(f"{name}_corr"))
    return columns


def latest_rows(df: DataFrame, date: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """The rows of the latest date, per series: all of them where several share it, and
    none where no row has a date.

    The latest date is an aggregate that rows are then compared with, so they stay where
    they are; ``df`` is read twice.
    """
    if not keys:
        return df.filter(F.col(date) == df.select(F.max(date)).scalar())
    latest = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max(date).alias("_latest"))
    same = F.col(date) == F.col("_latest")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(latest, same, "left_semi")
