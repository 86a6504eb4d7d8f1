"""Bring unlike series onto one row per period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def align_left(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Every row of ``base``, with the columns of the others where their period matches.

    Each of ``others`` must hold one row per ``on``. Joins carry no hints: the sides are
    already resampled, and adaptive execution broadcasts those that turn out small.
    """
    return reduce(lambda left, right: left.join(right, list(on), "left"), others, base)


def stack_series(frames: Mapping[str, DataFrame], date: str = "date", value: str = "value") -> DataFrame:
    """Frames of (date, value) as one long frame with their names in ``series_id``."""
    named = [df.select(F.lit(name).alias("series_id"), date, value) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, named)


def spread_series(
    df: DataFrame,
    on: Sequence[str],
    columns: Mapping[str, Mapping[str, str]],
    series: str = "series_id",
) -> DataFrame:
    """Turn stacked series into columns: one shuffle in place of one join per series.

    ``columns`` maps a series to {input column: output column}. The input must hold one
    row per series and ``on``.
    """
    cells = [
        F.max(F.when(F.col(series) == name, F.col(source))).alias(target)
        for name, renames in columns.items()
        for source, target in renames.items()
    ]
    return df.groupBy(*on).agg(*cells)


def relative(value: str, benchmark: str) -> Column:
    """Performance beyond the benchmark, in percentage points."""
    return F.col(value) - F.col(benchmark)


def drop_latest(df: DataFrame, period: str, keys: Sequence[str] = ()) -> DataFrame:
    """Leave out the latest period that the frame holds, per series.

    ``df`` must hold one row per series and period, so that a series fits a task.
    """
    latest = F.max(period).over(Window.partitionBy(*keys))
    return df.withColumn("_latest", latest).filter(F.col(period) < F.col("_latest")).drop("_latest")
