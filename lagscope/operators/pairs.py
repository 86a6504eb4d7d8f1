"""Correlation of many targets with many indicators at several lags.

Every target meets every indicator, so the cells are as many as the product; the rows that are
sent are not. Series are dealt to tiles of some hundred targets by some hundred indicators: a
series goes to each tile of its row or column, as one row that holds its values. A tile is a few
matrix products over the periods its series have, whatever the number of its cells.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.operators.ranking import RANK_DIGITS
from lagscope.sources.landing import materialize

TILE = 256
# Where less than this share of a sum of squares is left around the mean, a side does not vary.
LEAST_SPREAD = 1e-12


def _packed(series: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """One row per series: its periods in order, and their values. As many as the calendar has."""
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(period).isNotNull()
    point = F.struct(F.col(period).cast("long").alias("p"), F.col(value).cast("double").alias("v"))
    rows = series.filter(known).groupBy(F.col(key).alias("id")).agg(F.sort_array(F.collect_list(point)).alias("points"))
    return rows.select("id", F.col("points.p").alias("periods"), F.col("points.v").alias("amounts"))


def _matrix(table: pa.Table, base: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Values around their mean, 0 where there is none, and where there is one; of two values of
    a period the higher counts."""
    values, known = np.zeros((table.num_rows, width)), np.zeros((table.num_rows, width))
    for i in range(table.num_rows):
        at = table.column("periods")[i].values.to_numpy() - base
        values[i, at] = table.column("amounts")[i].values.to_numpy()
        known[i, at] = 1
    mean = values.sum(axis=1, keepdims=True) / np.maximum(known.sum(axis=1, keepdims=True), 1)
    return (values - mean) * known, known


def _moments(y: np.ndarray, has_y: np.ndarray, x: np.ndarray, has_x: np.ndarray) -> np.ndarray:
    """Correlation of every row of ``y`` with every row of ``x`` over the columns both have;
    NaN where it is undefined."""
    n = has_y @ has_x.T
    sum_y, sum_x = y @ has_x.T, has_y @ x.T
    of = np.maximum(n, 1)
    squares_y, squares_x = (y * y) @ has_x.T, has_y @ (x * x).T
    spread_y, spread_x = squares_y - sum_y * sum_y / of, squares_x - sum_x * sum_x / of
    varies = (n > 1) & (spread_y > LEAST_SPREAD * squares_y) & (spread_x > LEAST_SPREAD * squares_x)
    with np.errstate(divide="ignore", invalid="ignore"):
        found = (y @ x.T - sum_y * sum_x / of) / np.sqrt(spread_y * spread_x)
    return np.where(varies, np.clip(found, -1.0, 1.0), np.nan)


def _tile(lags: Mapping[str, int], most: int | None) -> Callable[[pa.Table], pa.Table]:
    names, steps = list(lags), list(lags.values())

    def tile(table: pa.Table) -> pa.Table:
        is_target = table.column("is_target").to_numpy()
        # In the order of their names, so that the same tile adds up the same way.
        sides = {side: table.filter(pa.array(is_target == side)).sort_by(name) for side, name in ((True, "target"), (False, "indicator"))}
        if not all(t.num_rows for t in sides.values()):
            return table.select(["target", "indicator"]).slice(0, 0).append_column("lag_period", pa.array([], pa.string())).append_column(
                "correlation", pa.array([], pa.float64())
            )
        periods = table.column("periods").combine_chunks().flatten().to_numpy()
        base, width = int(periods.min()), int(periods.max() - periods.min()) + 1
        (y, has_y), (x, has_x) = (_matrix(sides[side], base, width) for side in (True, False))
        cells = []
        for step in steps:
            # A lag of n periods: a target's column p meets an indicator's column p - n.
            late, early = slice(max(step, 0), width + min(step, 0)), slice(max(-step, 0), width - max(step, 0))
            empty = abs(step) >= width
            cells.append(np.full((len(y), len(x)), np.nan) if empty else _moments(y[:, late], has_y[:, late], x[:, early], has_x[:, early]))
        found = np.array(cells)
        lag, i, j = np.nonzero(~np.isnan(found))
        value = found[lag, i, j]
        if most is not None and len(value) > most:
            # The strongest of the tile, ties and all: which of them count is decided by names.
            strength = np.round(np.abs(value), RANK_DIGITS)
            least = np.partition(strength, len(strength) - most)[len(strength) - most]
            chosen = strength >= least
            lag, i, j, value = lag[chosen], i[chosen], j[chosen], value[chosen]
        return pa.table({
            "target": sides[True].column("target").take(pa.array(i)),
            "indicator": sides[False].column("indicator").take(pa.array(j)),
            "lag_period": pa.array([names[k] for k in lag], pa.string()),
            "correlation": pa.array(value),
        })

    return tile


def pair_correlations(
    targets: DataFrame, indicators: DataFrame, lags: Mapping[str, int], target: str, indicator: str, period: str,
    target_value: str, indicator_value: str, tile: int = TILE, most: int | None = None,
) -> DataFrame:
    """(``target``, ``indicator``, lag_period, correlation) of all pairs that have one.

    Both frames hold a row per series and ``period``, a whole number; ``lags`` names how many
    periods before the target's the indicator's value lies. With ``most``, only as many of each
    tile as may be among the ``most`` strongest. Values that are NULL or NaN, and rows without
    a period, count as missing; a null key is a series of its own.
    """
    rows = materialize(_packed(targets, target, period, target_value), "targets")
    columns = materialize(_packed(indicators, indicator, period, indicator_value), "indicators")
    n_rows, n_columns = (max(1, -(-df.count() // tile)) for df in (rows, columns))

    def dealt(df: DataFrame, own: int, other: int, is_target: bool) -> DataFrame:
        at = F.pmod(F.xxhash64("id"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        place = (at.alias("row"), every.alias("column")) if is_target else (every.alias("row"), at.alias("column"))
        names = (F.col("id").alias("target"), F.lit(None).cast(columns.schema["id"].dataType).alias("indicator"))
        if not is_target:
            names = (F.lit(None).cast(rows.schema["id"].dataType).alias("target"), F.col("id").alias("indicator"))
        return df.select(*place, F.lit(is_target).alias("is_target"), *names, "periods", "amounts")

    both = dealt(rows, n_rows, n_columns, True).unionByName(dealt(columns, n_columns, n_rows, False))
    kinds = [df.schema["id"].dataType.simpleString() for df in (rows, columns)]
    schema = f"target {kinds[0]}, indicator {kinds[1]}, lag_period string, correlation double"
    found = both.groupBy("row", "column").applyInArrow(_tile(lags, most), schema)
    return found.withColumnsRenamed({"target": target, "indicator": indicator})


def strongest_pairs(cells: DataFrame, k: int, target: str, indicator: str) -> DataFrame:
    """The k strongest of the cells, either sign, with their ``rank``; ties by name. Each tile
    sends its own strongest, and no task sees more than k of each other."""
    strength = F.abs(F.round("correlation", RANK_DIGITS))
    order = [strength.desc(), F.col(target).asc_nulls_last(), F.col(indicator).asc_nulls_last(), F.col("lag_period").asc()]
    first = cells.orderBy(*order).limit(k)
    listed = F.sort_array(F.collect_list(F.struct(
        (-strength).alias("_weakness"), F.col(target).isNull().alias("_t"), F.col(target), F.col(indicator).isNull().alias("_i"),
        F.col(indicator), F.col("lag_period"), F.col("correlation"),
    )))
    ranked = first.agg(listed.alias("cells")).select(F.posexplode("cells").alias("_place", "_cell"))
    names = [target, indicator, "lag_period", "correlation"]
    return ranked.select(*(F.col(f"_cell.{c}").alias(c) for c in names), (F.col("_place") + 1).cast("bigint").alias("rank"))
