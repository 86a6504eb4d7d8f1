"""Every operator and model as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagscope.operators import (
    drop_latest,
    latest_rows,
    load_report,
    pair_correlations,
    rank_by_strength,
    rank_overall,
    resample,
    spread_series,
    strongest_pairs,
    top_drivers,
    unique_failures_of_repeats,
    with_changes,
    with_changes_any_length,
)
from lagscope.plans import incremental, marts, models
from lagscope.plans.periods import QUARTERS_BACK, monthly_returns
from lagscope.plans.staging import stage_last_prices, stage_observations, stage_prices
from lagscope.registry import roles
from lagscope.session import scratch_dir
from lagscope.sources import (
    land_series,
    materialize,
    materialize_observed,
    read_chart_payloads,
    read_observation_payloads,
    read_series,
)
from lagscope.sources.versions import Versions
from lagscope.sources.schemas import NANOS_PER_SECOND, RAW_OBSERVATIONS, RAW_PRICES

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
# A month within all series of the test tables.
REVISED = "1997-05"


def tidy(df: DataFrame) -> DataFrame:
    """Decimals as doubles and all doubles rounded, to compare across engines."""
    numeric = (T.DoubleType, T.DecimalType)
    return df.select(
        *(
            F.round(F.col(f.name).cast("double"), DIGITS).alias(f.name) if isinstance(f.dataType, numeric) else f.name
            for f in df.schema.fields
        )
    )


def exact(df: DataFrame) -> DataFrame:
    """Decimals as text, with all their digits."""
    return df.select(
        *(F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
          for f in df.schema.fields)
    )


# --- typed raw tables ---------------------------------------------------------------


def _staged(table: str) -> Query:
    return lambda spark, sf_dir: exact(models.stage(table, roles.RAW_TABLES[table](spark, sf_dir)))


def stage_order_records(spark, sf_dir):
    return exact(stage_observations(roles.order_observations(spark, sf_dir)))


# --- models by name -----------------------------------------------------------------


def _model(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resampled model: from its staged rows, or where those are not resampled, from the
    states of their months."""
    table, make = models.INTERMEDIATE[name]
    raw = roles.RAW_TABLES[table](spark, sf_dir)
    if name in AS_OBSERVED:
        return make(models.share_states({table: raw})[table])
    return make(models.stage(table, raw))


AS_OBSERVED = {"int_fred_inventories", "int_fred_new_orders", "int_fred_semiconductor_ppi", "int_fred_inventories_yearly"}


def _intermediate(name: str) -> Query:
    return lambda spark, sf_dir: tidy(_model(name, spark, sf_dir))


# --- the fact and what is made from it ----------------------------------------------


def _fact(spark, sf_dir):
    return marts.fact_from_series(roles.all_series(spark, sf_dir))


def fact_quarter(spark, sf_dir):
    return tidy(_fact(spark, sf_dir))


def fact_quarter_joined(spark, sf_dir):
    quarters = ("int_smh_q", "int_sp500_q", "int_fred_new_orders_q", "int_fred_ppi_q", "int_fred_inventories_q")
    return tidy(marts.quarterly_fact(*(_model(name, spark, sf_dir) for name in quarters)))


def drop_latest_period(spark, sf_dir):
    changes = marts.quarter_changes(roles.line_series(spark, sf_dir))
    return tidy(drop_latest(changes, "year_quarter", ["series_id"]))


def spread_quarters(spark, sf_dir):
    changes = marts.quarter_changes(roles.order_series(spark, sf_dir))
    columns = {
        "sp500": {"value": "sp500_value", "yoy": "sp500_yoy"},
        "new_orders": {"value": "new_orders", "yoy": "new_orders_yoy"},
    }
    return tidy(spread_series(changes, ["year", "quarter", "year_quarter"], columns))


def lag_bank(spark, sf_dir):
    return tidy(marts.lagged_indicators(_fact(spark, sf_dir)))


def lag_correlation_wide(spark, sf_dir):
    return tidy(marts.correlation_matrix(_fact(spark, sf_dir)))


def _cells(spark, sf_dir):
    return marts.cells(marts.correlation_matrix(_fact(spark, sf_dir)))


def lag_correlation_long(spark, sf_dir):
    return tidy(_cells(spark, sf_dir))


def rank_drivers(spark, sf_dir):
    return tidy(rank_by_strength(_cells(spark, sf_dir)))


def rank_drivers_nan(spark, sf_dir):
    """Ranks where some values of the target and of an indicator are NaN, which is no value."""
    nan = F.lit(float("nan"))
    fact = _fact(spark, sf_dir).withColumns({
        marts.TARGET: F.when(F.col("quarter") == 2, nan).otherwise(F.col(marts.TARGET)),
        "new_orders_yoy": F.when(F.col("quarter") == 3, nan).otherwise(F.col("new_orders_yoy")),
    })
    return tidy(rank_by_strength(marts.cells(marts.correlation_matrix(fact))))


def top_two_drivers(spark, sf_dir):
    return tidy(top_drivers(_cells(spark, sf_dir), len(marts.DRIVERS)))


def latest_row(spark, sf_dir):
    return tidy(latest_rows(_fact(spark, sf_dir)))


def kpi_row(spark, sf_dir):
    return tidy(marts.kpi_from_fact(_fact(spark, sf_dir)))


def kpi_row_from_tables(spark, sf_dir):
    """The stored fact and matrix joined into the headline row, as a refresh does."""
    fact = materialize(_fact(spark, sf_dir), "fct_smh_q")
    matrix = materialize(marts.correlation_matrix(fact), "fct_smh_q_correlation")
    return tidy(marts.key_kpi(fact, matrix))


# --- panels of many series ----------------------------------------------------------

SUPPLIER = ["l_suppkey"]


def panel_quarter_change(spark, sf_dir):
    return tidy(roles.supplier_quarters(spark, sf_dir))


def panel_last_edge(spark, sf_dir):
    """Last prices where some are missing, negative, very large, or a fraction of a cent apart."""
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    edged = (
        F.when(line == 1, None)
        .when(line == 2, -price)
        .when(line == 3, price * 1e9)
        .when(line == 4, F.floor(price) + price / 1e9)
        .otherwise(price)
    )
    # The prices unrounded: they are picked, not computed. Their changes have more digits
    # than a comparison of doubles can hold.
    return roles.supplier_quarters(spark, sf_dir, edged).drop("smh_qoq", "smh_yoy")


def panel_monthly_return(spark, sf_dir):
    """Highest price on each supplier's last day of the month, against the month before."""
    monthly = resample(roles.supplier_days(spark, sf_dir), "month", "last", "price", keys=SUPPLIER)
    return tidy(with_changes(monthly, "price", {"monthly_return": 1}, ["date"], SUPPLIER))


def panel_monthly_prices(spark, sf_dir):
    """Month ends of the daily bars of each supplier, typed once they are picked."""
    raw = roles.raw_target_prices(spark, sf_dir, SUPPLIER)
    return tidy(monthly_returns(stage_last_prices(raw, "month", SUPPLIER), SUPPLIER))


def _nation_quarters(spark, sf_dir):
    """Order value per nation and quarter. Orders are summed per customer and quarter before
    customers meet them; those without a customer make up the nation NULL."""
    orders = roles.table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"), roles.cents(F.col("o_totalprice")).alias("cents")
    )
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = resample(orders, "quarter", "sum", "cents", keys=["o_custkey"])
    nations = sums.join(customers, sums.o_custkey == customers.c_custkey, "left")
    quarters = nations.groupBy("c_nationkey", "year", "quarter", "year_quarter").agg(F.sum("cents").alias("cents"))
    amounts = quarters.withColumn("cents", F.col("cents") / 100).withColumnRenamed("cents", "new_orders")
    steps = {f"new_orders_{name}": n for name, n in QUARTERS_BACK.items()}
    return with_changes(amounts, "new_orders", steps, ["year", "quarter"], ["c_nationkey"])


def panel_quarter_sum(spark, sf_dir):
    return tidy(_nation_quarters(spark, sf_dir))


def _pairs(spark, sf_dir, most=None):
    """Every supplier's yearly price change against every nation's change of orders, as many
    quarters before."""
    quarter = F.col("year") * 4 + F.col("quarter")
    suppliers = roles.supplier_quarters(spark, sf_dir).withColumn("period", quarter)
    nations = _nation_quarters(spark, sf_dir).withColumn("period", quarter)
    lags = {marts.LAG_LABELS[name]: n for name, n in marts.LAGS.items()}
    return pair_correlations(
        suppliers, nations, lags, "l_suppkey", "c_nationkey", "period", "smh_yoy", "new_orders_yoy", tile=64, most=most
    )


def pairs_correlation(spark, sf_dir):
    return tidy(_pairs(spark, sf_dir))


def pairs_strongest(spark, sf_dir):
    """The fifty strongest of all pairs and lags."""
    return tidy(strongest_pairs(_pairs(spark, sf_dir, 50), 50, "l_suppkey", "c_nationkey"))


def _supplier_fact(spark, sf_dir):
    return marts.fact_with_shared(
        roles.supplier_quarters(spark, sf_dir), roles.shared_quarters(spark, sf_dir), SUPPLIER
    )


def panel_fact(spark, sf_dir):
    return tidy(_supplier_fact(spark, sf_dir))


def _supplier_cells(spark, sf_dir):
    return marts.cells(marts.correlation_matrix(_supplier_fact(spark, sf_dir), SUPPLIER), SUPPLIER)


def panel_lag_correlation(spark, sf_dir):
    return tidy(_supplier_cells(spark, sf_dir))


def panel_rank_drivers(spark, sf_dir):
    return tidy(rank_by_strength(_supplier_cells(spark, sf_dir), SUPPLIER))


def panel_rank_overall(spark, sf_dir):
    return tidy(rank_overall(_supplier_cells(spark, sf_dir), SUPPLIER))


def panel_kpi(spark, sf_dir):
    return tidy(marts.kpi_from_fact(_supplier_fact(spark, sf_dir), SUPPLIER))


def row_change_long_series(spark, sf_dir):
    """Change on the line before, over the three series that the return flags make, each
    with a third of all rows and none resampled."""
    lines = roles.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.to_date("l_shipdate").alias("date"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("price"),
    )
    order = ["date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"]
    steps = {"change_1": 1, "change_12": 12}
    return tidy(with_changes_any_length(lines, "price", steps, order, ["l_returnflag"], block=1 << 14))


# --- landing ------------------------------------------------------------------------


def land_chart_payload(spark, sf_dir):
    """Bars per return flag and year written as one chart document each, read back."""
    bars = roles.raw_target_prices(spark, sf_dir, ["l_returnflag"])
    second = (F.col("date") / NANOS_PER_SECOND).cast("bigint").alias("second")
    year = F.year(F.timestamp_seconds(second)).alias("year")
    fields = ["second", "open", "high", "low", "close", "adj_close", "volume"]
    # At most one element per day of a year.
    days = (
        bars.withColumn("second", second)
        .groupBy("l_returnflag", year)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("d"))
    )
    quote = F.struct(*(F.col(f"d.{c}").alias(c) for c in ("open", "high", "low", "close", "volume")))
    indicators = F.struct(
        F.array(quote).alias("quote"), F.array(F.struct(F.col("d.adj_close").alias("adjclose"))).alias("adjclose")
    )
    result = F.array(F.struct(F.col("d.second").alias("timestamp"), indicators.alias("indicators")))
    documents = days.select(F.col("l_returnflag").alias("series_id"), F.struct(result.alias("result")).alias("chart"))
    path = scratch_dir(spark, "chart-payloads")
    documents.write.partitionBy("series_id").json(path)
    return tidy(read_chart_payloads(spark, path, one_per_line=True))


def land_observation_payload(spark, sf_dir):
    """Order records written as observation documents of one day each, one series for
    settled orders and one for pending, read back and typed."""
    records = roles.order_observations(spark, sf_dir)
    series = F.when(F.col("value") == ".", "pending").otherwise("settled")
    # A day's orders, cut into parts so that none grows with the data.
    part = F.pmod(F.xxhash64(*records.columns), F.lit(64))
    documents = (
        records.groupBy(series.alias("series_id"), "date", part.alias("part"))
        .agg(F.collect_list(F.struct(*records.columns)).alias("observations"))
        .select("series_id", "observations")
    )
    path = scratch_dir(spark, "observation-payloads")
    documents.write.partitionBy("series_id").json(path)
    landed = read_observation_payloads(spark, path, one_per_line=True)
    return tidy(stage_observations(landed, ["series_id"]))


def land_report(spark, sf_dir):
    """Rows, columns and types of the price table, observed as it is landed."""
    bars = roles.raw_target_prices(spark, sf_dir)
    landed, found = materialize_observed(bars, "smh_prices", rows=F.count(F.lit(1)))
    return load_report(landed, "smh_prices", found["rows"])


# --- checks -------------------------------------------------------------------------


def _landed(spark, sf_dir):
    """The raw tables landed once, prices and observations in one job each."""
    raw = {}
    for names, schema in (
        (models.RAW_PRICE_TABLES, RAW_PRICES),
        (models.RAW_OBSERVATION_TABLES, RAW_OBSERVATIONS),
    ):
        path = scratch_dir(spark, "raw")
        land_series({name: roles.RAW_TABLES[name](spark, sf_dir) for name in names}, path)
        raw |= {name: read_series(spark, path, name, schema) for name in names}
    return raw


def _checks(*kinds: str) -> Query:
    def run(spark, sf_dir):
        raw, names = _landed(spark, sf_dir), models.declared_models(kinds)
        states = models.share_states(raw)
        return models.run_checks(models.build_models(raw, names=names, states=states), kinds, states=states)

    return run


def refresh_models(spark, sf_dir):
    """A full refresh: views over the landed tables, marts as catalog tables; the rows of each."""
    raw = _landed(spark, sf_dir)
    states = models.share_states(raw)
    published = models.publish(spark, raw, scratch_dir(spark, "marts"), states=states)
    return models.row_counts({name: spark.table(name) for name in published}, states)


def _published(name: str) -> Query:
    """A mart as it is read back from the catalog after a full refresh."""

    def run(spark, sf_dir):
        models.publish(spark, _landed(spark, sf_dir), scratch_dir(spark, "marts"))
        return tidy(spark.table(name))

    return run


def _revised(spark, sf_dir) -> tuple[str, dict[str, DataFrame]]:
    """A version made from faulty rows of one month, then one after its revision."""
    raw, root = _landed(spark, sf_dir), scratch_dir(spark, "versions")
    faulty = {
        name: df.withColumns(
            {c: F.when(F.col("date").like(f"{REVISED}%"), F.lit("1")).otherwise(F.col(c)) for c in ("value",)}
        ) if name in models.RAW_OBSERVATION_TABLES else df
        for name, df in raw.items()
    }
    incremental.refresh(spark, faulty, root)
    incremental.refresh(spark, raw, root, months=[REVISED])
    return root, raw


def refresh_after_revision(spark, sf_dir):
    """The fact of a version that rewrote the one month whose observations were revised."""
    root, _ = _revised(spark, sf_dir)
    return tidy(Versions(spark, root).latest().read(spark, "fct_smh_q"))


def refresh_snapshot(spark, sf_dir):
    """The headline row beside the number of quarters in the fact it was made from, both of one
    version."""
    root, raw = _revised(spark, sf_dir)
    seen = incremental.snapshot(spark, root, raw)
    quarters = seen["fct_smh_q"].agg(F.count(F.lit(1)).alias("quarters"))
    return tidy(seen["fct_key_kpi"].withColumn("quarters", quarters.select("quarters").scalar()))


def refresh_panel_kpi(spark, sf_dir):
    """A panel staged, resampled, correlated and stored as one refresh; its headline rows."""
    raw = {name: make(spark, sf_dir, ["desk"]) for name, make in roles.RAW_TABLES.items()}
    models.publish(spark, raw, scratch_dir(spark, "marts"), ["desk"], "panel_")
    return tidy(spark.table("panel_fct_key_kpi"))


def _desk_buckets(spark, sf_dir):
    raw = {name: make(spark, sf_dir, ["desk"]) for name, make in roles.RAW_TABLES.items()}
    quarters = models.build_models(raw, names=models.FACT_INPUTS, keys=["desk"])
    return models.fact_from_buckets(quarters, scratch_dir(spark, "buckets"), ["desk"], 8)


def refresh_bucketed_fact(spark, sf_dir):
    """The fact of a panel from quarterly series stored in buckets."""
    return tidy(_desk_buckets(spark, sf_dir))


def dq_panel(spark, sf_dir):
    """Checks over the staged daily bars and the fact of every supplier."""
    staged = stage_prices(roles.raw_target_prices(spark, sf_dir, SUPPLIER), SUPPLIER)
    checked = {"stg_smh_prices": staged, "fct_smh_q": _supplier_fact(spark, sf_dir)}
    return models.run_checks(checked, keys=SUPPLIER)


def dq_order_records(spark, sf_dir):
    """Checks over every order as a staged record, with its missing values and repeated dates."""
    staged = stage_observations(roles.order_observations(spark, sf_dir))
    return models.run_checks({"stg_fred_new_orders": staged}, ("not_null", "unique"))


def dq_unique_records(spark, sf_dir):
    """Values of whole raw tables that must not repeat, and one that does, found by a filter first."""
    orders, lines = (roles.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    by_order = unique_failures_of_repeats(lines, "lineitem", ["l_linenumber"], ["l_orderkey"])
    return unique_failures_of_repeats(orders, "orders", ["o_orderkey", "o_custkey"]).unionAll(by_order)


QUERIES: dict[str, Query] = {
    "stage_prices": _staged("smh_prices"),
    "stage_benchmark": _staged("sp500_prices"),
    "stage_observations": stage_order_records,
    "stage_inventories": _staged("fred_inventories"),
    "stage_new_orders": _staged("fred_new_orders"),
    "stage_ppi": _staged("fred_semiconductor_ppi"),
    "monthly_last_return": _intermediate("int_smh_prices"),
    "monthly_last_return_benchmark": _intermediate("int_sp500_prices"),
    "monthly_change_inventory": _intermediate("int_fred_inventories"),
    "monthly_change_orders": _intermediate("int_fred_new_orders"),
    "monthly_change_ppi": _intermediate("int_fred_semiconductor_ppi"),
    "quarter_last_price": _intermediate("int_smh_q"),
    "quarter_last_benchmark": _intermediate("int_sp500_q"),
    "quarter_last_inventory": _intermediate("int_fred_inventories_q"),
    "quarter_sum_orders": _intermediate("int_fred_new_orders_q"),
    "quarter_avg_ppi": _intermediate("int_fred_ppi_q"),
    "year_last_price": _intermediate("int_smh_yearly"),
    "year_last_benchmark": _intermediate("int_sp500_yearly"),
    "year_december_inventory": _intermediate("int_fred_inventories_yearly"),
    "year_sum_orders": _intermediate("int_fred_new_orders_yearly"),
    "year_avg_ppi": _intermediate("int_fred_ppi_yearly"),
    "fact_quarter": fact_quarter,
    "fact_quarter_joined": fact_quarter_joined,
    "drop_latest_period": drop_latest_period,
    "spread_quarters": spread_quarters,
    "lag_bank": lag_bank,
    "lag_correlation_wide": lag_correlation_wide,
    "lag_correlation_long": lag_correlation_long,
    "rank_drivers": rank_drivers,
    "rank_drivers_nan": rank_drivers_nan,
    "top_drivers": top_two_drivers,
    "latest_row": latest_row,
    "kpi_row": kpi_row,
    "kpi_row_from_tables": kpi_row_from_tables,
    "panel_quarter_change": panel_quarter_change,
    "panel_last_edge": panel_last_edge,
    "panel_monthly_return": panel_monthly_return,
    "panel_monthly_prices": panel_monthly_prices,
    "panel_quarter_sum": panel_quarter_sum,
    "pairs_correlation": pairs_correlation,
    "pairs_strongest": pairs_strongest,
    "panel_fact": panel_fact,
    "panel_lag_correlation": panel_lag_correlation,
    "panel_rank_drivers": panel_rank_drivers,
    "panel_rank_overall": panel_rank_overall,
    "panel_kpi": panel_kpi,
    "row_change_long_series": row_change_long_series,
    "land_chart_payload": land_chart_payload,
    "land_observation_payload": land_observation_payload,
    "land_report": land_report,
    "refresh_models": refresh_models,
    "refresh_fact": _published("fct_smh_q"),
    "refresh_correlation": _published("fct_smh_q_correlation"),
    "refresh_kpi": _published("fct_key_kpi"),
    "refresh_after_revision": refresh_after_revision,
    "refresh_snapshot": refresh_snapshot,
    "refresh_bucketed_fact": refresh_bucketed_fact,
    "refresh_panel_kpi": refresh_panel_kpi,
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_grain": _checks("grain", "row_count"),
    "dq_panel": dq_panel,
    "dq_order_records": dq_order_records,
    "dq_unique_records": dq_unique_records,
}
