"""Error-tolerant typing of raw fields: what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date text and the exact numeric type of staged fields.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
EXACT_NUMERIC = "decimal(38,9)"
NANOS_PER_DAY = 86_400_000_000_000


def safe_date(text: Column) -> Column:
    """A full year-month-day text as a date. Spark alone would also take '2024'."""
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def safe_decimal(value: Column) -> Column:
    """Text or a floating number as an exact decimal; '.' and NaN become NULL."""
    return value.try_cast(EXACT_NUMERIC)


def safe_bigint(number: Column) -> Column:
    """The nearest whole number, halves away from zero (a bare cast cuts off)."""
    return F.round(number).try_cast("bigint")


def epoch_nanos_to_date(nanos: Column) -> Column:
    """The UTC day of a count of nanoseconds, in whole numbers and in any session time zone."""
    start_of_day = nanos - F.pmod(nanos, F.lit(NANOS_PER_DAY))
    return F.date_from_unix_date(F.call_function("div", start_of_day, F.lit(NANOS_PER_DAY)).cast("int"))
