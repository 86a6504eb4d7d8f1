"""Daily or monthly rows to months, quarters or years.

Every rule is one hash aggregation that combines rows before the shuffle. A task
sends at most one row per series and period, so a series that holds a large share
of all rows costs no more to move than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagscope.functions.ordering import row_order
from lagscope.functions.periods import PERIOD_COLUMNS, period_labels, period_parts

RULES = ("last", "sum", "avg")


def _by_period(df: DataFrame, keys: Sequence[str], grain: str, date: str):
    parts = period_parts(F.col(date), grain)
    return df.withColumns(parts).groupBy(*keys, *parts)


def last_rows(
    df: DataFrame,
    grain: str,
    columns: Sequence[str],
    date: str = "date",
    keys: Sequence[str] = (),
    order: Column | None = None,
) -> DataFrame:
    """The latest row of each period, with its date; NULL values are kept as they are.

    Rows that share the latest date are told apart by ``order`` (see
    ``functions.ordering``); by default one is picked by a hash, the same on every run.
    """
    if order is None:
        order = row_order(F.col(date), [F.col(c) for c in columns])
    picked = (
        _by_period(df.withColumn("_order", order), keys, grain, date)
        .agg(F.max(date).alias("_date"), *(F.max_by(c, "_order").alias(c) for c in columns))
        .withColumns(period_labels(grain))
    )
    return picked.select(*keys, F.col("_date").alias(date), *PERIOD_COLUMNS[grain], *columns)


def resample(
    df: DataFrame,
    grain: str,
    rule: str,
    value: str,
    date: str = "date",
    keys: Sequence[str] = (),
    out: str | None = None,
    order: Column | None = None,
) -> DataFrame:
    """One value per period by ``rule``: the last observation, their sum or their average.

    Only "last" returns a date, that of the observation taken.
    """
    out = out or value
    if rule == "last":
        return last_rows(df, grain, [value], date, keys, order).withColumnRenamed(value, out)
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}: use one of {RULES}")
    combine = F.sum if rule == "sum" else F.avg
    return (
        _by_period(df, keys, grain, date)
        .agg(combine(value).alias(out))
        .withColumns(period_labels(grain))
        .select(*keys, *PERIOD_COLUMNS[grain], out)
    )


def resample_by_rule(
    df: DataFrame,
    grain: str,
    rules: Mapping[str, str],
    series: str = "series_id",
    value: str = "value",
    date: str = "date",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Resample stacked series, each by its own rule, in one aggregation.

    ``date`` in the result is the latest date of the period, under every rule. Series
    without a rule are left out.
    """
    unknown = set(rules.values()) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules {sorted(unknown)}: use some of {RULES}")

    def is_a(rule: str) -> Column:
        return F.col(series).isin([s for s, r in rules.items() if r == rule])

    def of(rule: str) -> Column:
        return F.when(is_a(rule), F.col(value))

    order = row_order(F.col(date), [F.col(value)])
    return (
        _by_period(df.filter(F.col(series).isin(list(rules))).withColumn("_order", order), [*keys, series], grain, date)
        .agg(
            F.max(date).alias(date),
            F.max_by(value, "_order").cast("double").alias("_last"),
            F.sum(of("sum")).cast("double").alias("_sum"),
            F.avg(of("avg")).cast("double").alias("_avg"),
        )
        .withColumn(
            value,
            F.when(is_a("last"), F.col("_last")).when(is_a("sum"), F.col("_sum")).when(is_a("avg"), F.col("_avg")),
        )
        .withColumns(period_labels(grain))
        .select(*keys, series, date, *PERIOD_COLUMNS[grain], value)
    )
