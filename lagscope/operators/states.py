"""Mergeable states of months, from which months, quarters and years all follow.

One reading of a series gives, per month: how many rows, on which days, the last row, the
sum and number of the values, and what is missing. States of months add up to those of
quarters and years, so however many models a table feeds, its rows are read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagscope.functions.ordering import row_order
from lagscope.functions.periods import PERIOD_COLUMNS, period_labels, period_parts

AVERAGE = "decimal(38,13)"


def month_states(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), date: str = "date", total: str | None = None,
    checked: Sequence[str] = (),
) -> DataFrame:
    """One row per series and month: ``rows``, ``days`` (a bit per day that has a row), the
    last row's ``columns`` and date, sum and number of ``total``, and per ``checked`` column
    how many rows lack it. Rows without a date make up the month NULL."""
    order = row_order(F.col(date), [F.col(c) for c in columns])
    month = {"month_start": F.trunc(date, "MM"), "_order": order}
    sums = [F.sum(total).alias("_sum"), F.count(total).alias("_count")] if total else []
    return (
        df.withColumns(month)
        .groupBy(*keys, "month_start")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(date) - 1)).alias("days"),
            F.max(date).alias("_date"),
            *(F.max_by(c, "_order").alias(c) for c in columns),
            F.max("_order").alias("_order"),
            *sums,
            *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in checked),
        )
    )


def _average(total: Column, count: Column, kind: T.DataType) -> Column:
    """As ``avg`` gives it. A quotient of two wide decimals would keep nine digits, so the sum
    is taken narrower, where it fits."""
    if not isinstance(kind, T.DecimalType):
        return F.try_divide(total, count)
    narrow = F.try_divide(total.try_cast("decimal(28,9)"), count.try_cast("decimal(10,0)"))
    return F.coalesce(narrow.cast(AVERAGE), F.try_divide(total, count).cast(AVERAGE))


@dataclass(frozen=True)
class PeriodStates:
    """Stored states of months, and the rows that they came from."""

    frame: DataFrame
    rows: DataFrame
    keys: tuple[str, ...] = ()
    #: No series has two rows in a month, so a state's last row is all that its month has.
    single: bool = False

    def _by_period(self, grain: str):
        parts = period_parts(F.col("month_start"), grain)
        return self.frame.withColumns(parts).groupBy(*self.keys, *parts)

    def last_rows(self, grain: str, columns: Sequence[str]) -> DataFrame:
        """As ``resample.last_rows`` over the rows."""
        if grain == "month":
            picked = self.frame
        else:
            picked = self._by_period(grain).agg(
                F.max("_date").alias("_date"), *(F.max_by(c, "_order").alias(c) for c in columns)
            )
        labelled = picked.withColumns(period_labels(grain))
        return labelled.select(*self.keys, F.col("_date").alias("date"), *PERIOD_COLUMNS[grain], *columns)

    def resample(self, grain: str, rule: str, value: str, out: str) -> DataFrame:
        """As ``resample.resample`` over the rows."""
        if rule == "last":
            return self.last_rows(grain, [value]).withColumnRenamed(value, out)
        total, kind = F.sum("_sum"), self.frame.schema["_sum"].dataType
        combined = total if rule == "sum" else _average(total, F.sum("_count"), kind)
        summed = self._by_period(grain).agg(combined.alias(out)).withColumns(period_labels(grain))
        return summed.select(*self.keys, *PERIOD_COLUMNS[grain], out)

    def repeated_days(self) -> DataFrame:
        """Months with more rows than days that have one: only there can a date repeat."""
        return self.frame.filter(
            F.col("month_start").isNotNull() & (F.col("rows") > F.bit_count("days"))
        ).select(*self.keys, "month_start")

    def failing_dates(self, date: str = "date") -> int:
        """How many dates occur more than once in their series. The rows are read again only
        where some month has more rows than days, and only such months are shuffled."""
        suspects = self.repeated_days()
        if suspects.isEmpty():
            return 0
        month = self.rows.select(*self.keys, date, F.trunc(date, "MM").alias("month_start"))
        same = month["month_start"] == suspects["month_start"]
        for k in self.keys:
            same &= month[k].eqNullSafe(suspects[k])
        counted = month.join(suspects, same, "left_semi").groupBy(*self.keys, date).agg(F.count(F.lit(1)).alias("n"))
        return counted.filter("n > 1").count()

    def missing(self, columns: Sequence[str]) -> DataFrame:
        """One row: how many rows lack each of ``columns``."""
        return self.frame.agg(*(F.coalesce(F.sum(f"missing_{c}"), F.lit(0)).alias(c) for c in columns))

    def row_count(self) -> DataFrame:
        return self.frame.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"))
