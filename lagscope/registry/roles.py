"""The test tables in the roles of the raw sources.

``lineitem`` gives the target's prices, the price index and the inventories;
``orders`` gives the benchmark and the new orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.functions.casting import EXACT_NUMERIC, NANOS_PER_DAY
from lagscope.operators import resample, with_changes
from lagscope.plans.marts import SERIES_RULES, quarter_changes
from lagscope.plans.periods import QUARTERS_BACK


# The columns used of each test table.
SCHEMAS = {
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz""",
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": "c_custkey bigint, c_nationkey int",
}


# The series of a panel that both fact tables can be cut into: by order number.
DESKS = 3
ORDER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return rows.withColumn("desk", F.col(ORDER_KEYS[name]) % DESKS) if name in ORDER_KEYS else rows


def _nanos(date: Column) -> Column:
    return F.unix_date(date).cast("bigint") * NANOS_PER_DAY


def cents(amount: Column) -> Column:
    """Exact under any order of addition, and on the fast path of hash aggregation."""
    return F.rint(amount * 100).cast("bigint")


def amount(cents: Column) -> Column:
    return (cents.cast("decimal(38,0)") / 100).cast("decimal(38,2)")


def _unit_price() -> Column:
    return F.col("l_extendedprice") / F.col("l_quantity")


def raw_target_prices(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """One bar per day of shipping, in the shape of a raw price table."""
    price, lines = F.col("l_extendedprice"), table(spark, sf_dir, "lineitem")
    return (
        lines.groupBy(*keys, F.to_date("l_shipdate").alias("day"))
        .agg(
            F.max(F.when(F.col("l_linenumber") == 1, price)).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(price * (1 - F.col("l_discount"))).alias("close"),
            F.max(price).alias("adj_close"),
            (F.sum(cents(F.col("l_quantity"))) / 200).alias("volume"),
        )
        .select(*keys, _nanos(F.col("day")).alias("date"), "open", "high", "low", "close", "adj_close", "volume")
    )


def raw_benchmark_prices(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    price, orders = F.col("o_totalprice"), table(spark, sf_dir, "orders")
    return (
        orders.groupBy(*keys, F.to_date("o_orderdate").alias("day"))
        .agg(
            F.max(F.when(F.col("o_orderstatus") == "O", price)).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(F.when(F.col("o_orderstatus") == "F", price)).alias("close"),
            F.max(price).alias("adj_close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .select(*keys, _nanos(F.col("day")).alias("date"), "open", "high", "low", "close", "adj_close", "volume")
    )


def _raw_monthly(rows: DataFrame, date: str, value: Column, keys: Sequence[str] = ()) -> DataFrame:
    """One observation per month, all fields as text, as a provider sends them."""
    return (
        rows.withColumn("day", F.to_date(date))
        .groupBy(*keys, F.trunc("day", "MM").alias("month_start"))
        .agg(F.min("day").alias("first"), F.max("day").alias("last"), value.alias("value"))
        .select(
            *keys,
            F.col("first").cast("string").alias("realtime_start"),
            F.col("last").cast("string").alias("realtime_end"),
            F.col("month_start").cast("string").alias("date"),
            F.col("value").cast("string").alias("value"),
        )
    )


def raw_new_orders(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    total = amount(F.sum(cents(F.col("o_totalprice"))))
    return _raw_monthly(table(spark, sf_dir, "orders"), "o_orderdate", total, keys)


def raw_price_index(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return _raw_monthly(returned, "l_shipdate", F.max(_unit_price()), keys)


def raw_inventories(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    total = amount(F.sum(cents(F.col("l_quantity"))))
    return _raw_monthly(table(spark, sf_dir, "lineitem"), "l_shipdate", total, keys)


RAW_TABLES = {
    "smh_prices": raw_target_prices,
    "sp500_prices": raw_benchmark_prices,
    "fred_inventories": raw_inventories,
    "fred_new_orders": raw_new_orders,
    "fred_semiconductor_ppi": raw_price_index,
}


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an observation record with the faults a provider's records have:
    a field that is no date, and "." for a value that is not known yet."""
    pending = F.col("o_orderstatus") == "P"
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("realtime_start"),
        F.when(pending, F.col("o_orderpriority"))
        .otherwise(F.to_date("o_orderdate").cast("string"))
        .alias("realtime_end"),
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.when(pending, ".").otherwise(amount(cents(F.col("o_totalprice"))).cast("string")).alias("value"),
    )


def _stacked(days: DataFrame, series: dict[str, tuple[Column, Column]]) -> DataFrame:
    cells = F.array(
        *(
            F.struct(F.lit(name).alias("series_id"), date.alias("date"), value.cast(EXACT_NUMERIC).alias("value"))
            for name, (date, value) in series.items()
        )
    )
    return days.select(F.inline(cells)).filter(F.col("value").isNotNull())


def _observed(stacked: DataFrame) -> DataFrame:
    """Sum the series that add up over a month; the others take their highest."""
    total = F.sum(F.when(F.col("series_id").isin("inventory", "new_orders"), F.col("value")))
    return stacked.groupBy("series_id", "date").agg(F.coalesce(total, F.max("value")).alias("value"))


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, inventories and price index per day, stacked, from one scan."""
    day, month = F.col("day"), F.trunc("day", "MM")
    days = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(
            F.max("l_extendedprice").alias("price"),
            F.sum(cents(F.col("l_quantity"))).alias("cents"),
            F.max(F.when(F.col("l_returnflag") == "R", _unit_price())).alias("unit_price"),
        )
    )
    series = {
        "smh": (day, F.col("price")),
        "inventory": (month, amount(F.col("cents"))),
        "semiconductor_ppi": (month, F.col("unit_price")),
    }
    return _stacked(days, series)


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark and new orders per day, stacked, from one scan."""
    day, month = F.col("day"), F.trunc("day", "MM")
    days = (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_totalprice").alias("price"), F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    )
    series = {"sp500": (day, F.col("price")), "new_orders": (month, amount(F.col("cents")))}
    return _stacked(days, series)


def line_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three series in ``lineitem`` as stacked observations."""
    return _observed(_line_rows(spark, sf_dir))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two series in ``orders`` as stacked observations."""
    return _observed(_order_rows(spark, sf_dir))


def all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five series as stacked observations, from one scan of each table."""
    return _observed(_line_rows(spark, sf_dir).unionByName(_order_rows(spark, sf_dir)))


def supplier_days(spark: SparkSession, sf_dir: str, price: Column | None = None) -> DataFrame:
    """The highest price of each supplier and day; NULL where the day has none.

    Any price is ordered by its own value: negative ones, large ones, and two that differ
    by less than a cent.
    """
    price = F.col("l_extendedprice") if price is None else price
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(F.max(price).alias("price"))


def supplier_quarters(spark: SparkSession, sf_dir: str, price: Column | None = None) -> DataFrame:
    """A target per supplier: the highest price on its last day of each quarter."""
    days = supplier_days(spark, sf_dir, price)
    quarters = resample(days, "quarter", "last", "price", keys=["l_suppkey"], out="smh_value")
    steps = {f"smh_{name}": n for name, n in QUARTERS_BACK.items()}
    return with_changes(quarters, "smh_value", steps, ["year", "quarter"], ["l_suppkey"])


def shared_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked quarters of the benchmark and the indicators."""
    names = [name for name in SERIES_RULES if name != "smh"]
    return quarter_changes(all_series(spark, sf_dir).filter(F.col("series_id").isin(names)))
