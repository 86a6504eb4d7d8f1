"""Pearson correlation of a target with earlier values of indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagscope.operators.change import with_lags


def correlation(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are known, which NaN is not; NULL for under two
    such rows or where either side does not vary. Its last digits depend on the order in which
    tasks add up; ``lag_correlation`` gives the same ones on every run.

    Built-in ``corr`` raises in ANSI mode where a side does not vary. That is seen from
    its lowest and highest value: a variance put together from several tasks can come out
    a little above zero.
    """
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    x, y = F.when(both, x), F.when(both, y)
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


# A value is taken as a whole number of this many bits, next to the largest of its group.
VALUE_BITS = 40
# Whole numbers are multiplied in two halves, so that sums of products fit a long: of up to
# two million rows per group, beyond which the job stops.
HALF = VALUE_BITS // 2


def known(x: Column) -> Column:
    """The value as a double; NaN is no value."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def whole(x: Column, largest: Column) -> Column:
    """``x`` as a whole number, in units of a power of two that ``largest`` decides."""
    exponent = F.floor(F.log2(largest))
    unit = F.pow(F.lit(2.0), VALUE_BITS - 1 - exponent)
    return F.when(largest > 0, F.rint(x * unit)).otherwise(x * 0).cast("bigint")


def _halves(x: Column) -> tuple[Column, Column]:
    return F.shiftright(x, HALF), x.bitwiseAND(F.lit((1 << HALF) - 1))


def _sum_of_products(x: Column, y: Column) -> Column:
    """Exact: sums of whole numbers do not depend on how rows are dealt to tasks."""
    (xh, xl), (yh, yl) = _halves(x), _halves(y)
    parts = (F.sum(xh * yh), F.sum(xh * yl + xl * yh), F.sum(xl * yl))
    high, middle, low = (p.cast("decimal(20,0)") for p in parts)
    shift = F.lit(1 << HALF).cast("decimal(8,0)")
    return ((high * shift + middle) * shift + low).cast("decimal(38,0)")


def whole_correlation(x: Column, y: Column) -> Column:
    """Correlation of two columns of whole numbers (see ``whole``) over the rows where both are
    known; NULL for under two such rows or where either side does not vary.

    Built-in ``corr`` adds doubles in whatever order tasks end, and raises in ANSI mode where
    a side does not vary. Here all sums are of whole numbers, so a correlation has the same bits
    under any partitioning; it lies in -1..1.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    n = F.count(x).cast("decimal(8,0)")
    total_x, total_y = (F.sum(c).cast("decimal(19,0)") for c in (x, y))

    def spread(products: Column, a: Column, b: Column) -> Column:
        # n * sum(ab) - sum(a) * sum(b): whole numbers of up to 123 bits.
        return ((n * products).cast("decimal(38,0)") - (a * b).cast("decimal(38,0)")).cast("double")

    shared = spread(_sum_of_products(x, y), total_x, total_y)
    own = [spread(_sum_of_products(c, c), t, t) for c, t in ((x, total_x), (y, total_y))]
    ratio = F.try_divide(shared, F.sqrt(own[0]) * F.sqrt(own[1]))
    # Both of these functions pass over NULL.
    return F.when(ratio.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))


def lag_bank(
    df: DataFrame,
    indicators: Mapping[str, str],
    lags: Mapping[str, int],
    order: Sequence[str],
    keep: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per input row and indicator, with the indicator's value at each lag.

    ``indicators`` maps column to label, ``lags`` names the lag columns. ``keep`` are
    columns carried along, such as the target. All lags share one window.
    """
    carried = [*keys, *order, *(c for c in keep if c not in order)]
    cells = F.array(
        *(
            F.struct(F.lit(label).alias("indicator"), F.col(column).alias("value"))
            for column, label in indicators.items()
        )
    )
    long = df.select(*carried, F.inline(cells))
    # Sent by series alone, so the grouping that follows finds its rows in place.
    return with_lags(long, "value", lags, order, [*keys, "indicator"])


def lag_correlation(
    bank: DataFrame, target: str, lags: Mapping[str, int], keys: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per indicator, one column per lag. ``extra`` are further aggregates.

    The rows of a group lie together already (``lag_bank``), so its largest values cost no
    shuffle. The same rows give the same bits on every run.
    """
    group = Window.partitionBy(*keys, "indicator")
    sides = [target, *lags]
    largest = {f"_most_{c}": F.max(F.abs(known(F.col(c)))).over(group) for c in sides}
    numbers = {f"_whole_{c}": whole(known(F.col(c)), F.col(f"_most_{c}")) for c in sides}
    return bank.withColumns(largest).withColumns(numbers).groupBy(*keys, "indicator").agg(
        *(whole_correlation(F.col(f"_whole_{target}"), F.col(f"_whole_{lag}")).alias(lag) for lag in lags), *extra
    )


def correlation_cells(matrix: DataFrame, labels: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Lag columns as rows, one per (indicator, lag); empty cells are kept.

    ``labels`` maps lag column to the text shown for it.
    """
    cells = F.array(
        *(F.struct(F.lit(text).alias("lag_period"), F.col(lag).alias("correlation")) for lag, text in labels.items())
    )
    return matrix.select(*keep, "indicator", F.inline(cells))
