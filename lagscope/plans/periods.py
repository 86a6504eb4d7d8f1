"""Monthly, quarterly and yearly series with their changes, from staged tables or from the
states of their months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.functions import month_label
from lagscope.operators import PeriodStates, last_rows, resample, with_changes, with_changes_any_length

# How many rows back each change looks.
MONTHS_BACK = {"yoy": 12, "mom": 1}
QUARTERS_BACK = {"qoq": 1, "yoy": 4}
YEAR_END_MONTH = 12
PRICE_COLUMNS = ["open", "high", "low", "close", "adjusted_close", "volume"]


Source = DataFrame | PeriodStates


def _resampled(source: Source, grain: str, rule: str, value: str, out: str, keys: Sequence[str]) -> DataFrame:
    if isinstance(source, PeriodStates):
        return source.resample(grain, rule, value, out)
    return resample(source, grain, rule, value, keys=keys, out=out)


def monthly_prices(source: Source, keys: Sequence[str] = ()) -> DataFrame:
    """The last trading day of each month and the return on the month before."""
    if isinstance(source, PeriodStates):
        return monthly_returns(source.last_rows("month", PRICE_COLUMNS), keys)
    return monthly_returns(last_rows(source, "month", PRICE_COLUMNS, keys=keys), keys)


def monthly_returns(month_ends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One staged row per month, with its label and the return on the row before."""
    labelled = month_ends.withColumn("month", month_label(F.col("date")))
    changed = with_changes(labelled, "adjusted_close", {"monthly_return": 1}, ["date"], keys)
    return changed.select(*keys, "date", *PRICE_COLUMNS, "month", "monthly_return")


def _observed(source: Source, keys: Sequence[str]) -> tuple[DataFrame, bool]:
    """(date, value) as observed, and whether the calendar bounds the rows of a series: then
    they fit a window. They do where no series has two rows in a month."""
    if not isinstance(source, PeriodStates):
        return source.select(*keys, "date", "value"), False
    if source.single:
        return source.last_rows("month", ["value"]).select(*keys, "date", "value"), True
    return source.rows.select(*keys, "date", "value"), False


def _changes(df: DataFrame, value: str, steps: dict[str, int], order: Sequence[str], keys: Sequence[str], bounded: bool):
    """Rows may share a date, so the value breaks ties: the changes are the same on every run."""
    change = with_changes if bounded else with_changes_any_length
    return change(df, value, steps, [*order, value], keys)


def monthly_observations(source: Source, value: str, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    """Observations as they are, with changes on one and on twelve rows before.

    Rows are not resampled here, and their dates may repeat without limit. Where states of
    months say that none does, a series is as long as the calendar; else no series is brought
    into one task, and building the frame sorts and writes the rows.
    """
    observed, bounded = _observed(source, keys)
    named = observed.select(*keys, "date", month_label(F.col("date")).alias("month"), F.col("value").alias(value))
    steps = {f"{prefix}_{name}": n for name, n in MONTHS_BACK.items()}
    return _changes(named, value, steps, ["date"], keys, bounded)


def quarterly(
    staged: Source, rule: str, source: str, value: str, prefix: str, keys: Sequence[str] = ()
) -> DataFrame:
    steps = {f"{prefix}_{name}": n for name, n in QUARTERS_BACK.items()}
    values = _resampled(staged, "quarter", rule, source, value, keys)
    return with_changes(values, value, steps, ["year", "quarter"], keys)


def yearly(
    staged: Source, rule: str, source: str, value: str, change: str, keys: Sequence[str] = ()
) -> DataFrame:
    values = _resampled(staged, "year", rule, source, value, keys)
    changed = with_changes(values, value, {change: 1}, ["year"], keys)
    dated = ["date"] if rule == "last" else []
    return changed.select(*keys, "year", *dated, value, change)


def yearly_at_year_end(source: Source, value: str, change: str, keys: Sequence[str] = ()) -> DataFrame:
    """December's observation for the year; a year without one has no row. Dates may repeat, as
    in ``monthly_observations``."""
    observed, bounded = _observed(source, keys)
    december = observed.filter(F.month("date") == YEAR_END_MONTH).select(
        *keys, "date", F.year("date").cast("bigint").alias("year"), F.col("value").alias(value)
    )
    return _changes(december, value, {change: 1}, ["year", "date"], keys, bounded)
