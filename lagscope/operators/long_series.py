"""Lags over series of any length.

A plain window takes a whole series into one task. Where one series holds a third of
all rows, that task never ends. Here the rows are sorted across all tasks, numbered,
and cut into blocks of consecutive rows whatever series they belong to. Each block is
also shown the few rows before it, so the window runs per block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagscope.functions.arithmetic import percent_change
from lagscope.session import scratch_dir

DEFAULT_BLOCK = 1 << 20
# monotonically_increasing_id: the partition above this bit, the row within it below.
ROW_BITS = 33


def with_positions(df: DataFrame, order: Sequence[str], position: str = "position") -> DataFrame:
    """Number all rows from 0 in the order given.

    The sorted rows are written to the shared folder before their partitions are
    counted: a task run again could otherwise cut its partition elsewhere. So building
    the frame starts a job. Rows that ``order`` does not tell apart are split as well.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "sorted")
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    in_order = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    numbered = in_order.withColumn("_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_part", F.shiftright("_id", ROW_BITS))
    # One row per sorted partition: their number is a setting and does not grow with the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    row = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return rows.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + row).alias(position))


def with_lags_any_length(
    df: DataFrame,
    value: str,
    lags: Mapping[str, int],
    order: Sequence[str],
    keys: Sequence[str] = (),
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """As ``change.with_lags``, without a limit on the rows of one series.

    Rows that ``order`` does not tell apart come in any order, as in a window.
    """
    reach = max(lags.values())
    block = max(block, reach)
    home = F.call_function("div", F.col("position"), F.lit(block))
    shown_to_next = F.col("position") % block >= block - reach
    blocks = F.when(shown_to_next, F.array(home, home + 1)).otherwise(F.array(home))
    window = Window.partitionBy("_block").orderBy("position")
    series = F.struct(F.lit(0), *(F.col(k) for k in keys))

    def lagged(n: int):
        same_series = F.lag("_series", n).over(window) == F.col("_series")
        return F.when(same_series, F.lag(value, n).over(window))

    return (
        with_positions(df, [*keys, *order])
        .withColumns({"_home": home, "_series": series})
        .withColumn("_block", F.explode(blocks))
        .withColumns({name: lagged(n) for name, n in lags.items()})
        .filter(F.col("_block") == F.col("_home"))
        .select(*df.columns, *lags)
    )


def with_changes_any_length(
    df: DataFrame,
    value: str,
    steps: Mapping[str, int],
    order: Sequence[str],
    keys: Sequence[str] = (),
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """As ``change.with_changes``, without a limit on the rows of one series."""
    earlier = {f"_before_{n}": n for n in steps.values()}
    lagged = with_lags_any_length(df, value, earlier, order, keys, block)
    changes = (percent_change(F.col(value), F.col(f"_before_{n}")).alias(name) for name, n in steps.items())
    return lagged.select(*df.columns, *changes)
