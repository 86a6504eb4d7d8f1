"""Ratios that yield NULL rather than an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision, NULL on a zero divisor.

    Two decimal(38,9) operands would leave only six decimals of quotient.
    """
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_change(current: Column, earlier: Column) -> Column:
    return (ratio(current, earlier) - 1) * 100
