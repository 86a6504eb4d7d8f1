"""Raw tables to typed ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.functions import epoch_nanos_to_date, safe_bigint, safe_date, safe_decimal
from lagscope.operators import last_rows

RAW_PRICE_FIELDS = ["date", "open", "high", "low", "close", "adj_close", "volume"]


def stage_prices(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    exact = {"open": "open", "high": "high", "low": "low", "close": "close", "adjusted_close": "adj_close"}
    return raw.select(
        *keys,
        epoch_nanos_to_date(F.col("date")).alias("date"),
        *(safe_decimal(F.col(source)).alias(name) for name, source in exact.items()),
        safe_bigint(F.col("volume")).alias("volume"),
    )


def stage_last_prices(raw: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last trading day of each period, staged: rows are picked first and typed then.

    As ``last_rows`` over ``stage_prices``, for large panels: to make exact decimals of all
    prices takes longer than to find the last ones.
    """
    days = raw.withColumn("_day", epoch_nanos_to_date(F.col("date")))
    return stage_prices(last_rows(days, grain, RAW_PRICE_FIELDS, "_day", keys), keys)


def stage_observations(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        *keys,
        *(safe_date(F.col(c)).alias(c) for c in ("realtime_start", "realtime_end", "date")),
        safe_decimal(F.col("value")).alias("value"),
    )
