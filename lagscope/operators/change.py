"""Values of earlier rows of a series, and changes against them.

A lag counts rows, not calendar periods: where a month is missing, the lag reaches
one month further back. The windows here take one series per task, which the
calendar bounds once a frame holds one row per series and period. For rows that are
not resampled see ``long_series``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagscope.functions.arithmetic import percent_change


def _in_order(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)


def with_lags(
    df: DataFrame, value: str, lags: Mapping[str, int], order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add one column per entry of ``lags``: the value that many rows before."""
    window = _in_order(keys, order)
    return df.withColumns({name: F.lag(value, n).over(window) for name, n in lags.items()})


def with_changes(
    df: DataFrame, value: str, steps: Mapping[str, int], order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add one column per entry of ``steps``: percent change on that many rows before."""
    window = _in_order(keys, order)
    return df.withColumns(
        {name: percent_change(F.col(value), F.lag(value, n).over(window)) for name, n in steps.items()}
    )
