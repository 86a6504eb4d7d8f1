"""What the physical plans must and must not hold, so that they work at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lagscope.plans import models
from lagscope.registry import queries, roles
from lagscope.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

# Queries that write a table first; what is left of their plan reads that. Pairs of series are
# matrix products in tasks.
WRITING = ("pairs_", "land_", "dq_", "refresh_", "kpi_row_from", "row_change", "panel_rank_overall", "monthly_change", "year_dec")
LANDING = {name for name in QUERIES if name.startswith(WRITING)}


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LANDING))
def test_all_work_stays_in_the_jvm_and_is_combined_before_a_shuffle(spark, name):
    text = plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|Arrow", text)
    # The aggregation next to each scan is a hash aggregation, so rows are not sorted first.
    for line, following in zip(text.splitlines(), text.splitlines()[1:]):
        if "Exchange" in line and "Aggregate" in following:
            assert "HashAggregate" in following, following


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("quarter_last_price", {"l_extendedprice", "l_shipdate"}),
        ("quarter_avg_ppi", {"l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate"}),
        ("quarter_sum_orders", {"o_totalprice", "o_orderdate"}),
        ("panel_quarter_change", {"l_suppkey", "l_extendedprice", "l_shipdate"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_a_filter_reaches_the_scan(spark):
    assert "EqualTo(l_returnflag,R)" in plan(spark, "quarter_avg_ppi")


@pytest.mark.parametrize("name", ["fact_quarter", "lag_correlation_wide", "kpi_row", "rank_drivers"])
def test_each_table_is_scanned_once(spark, name):
    text = plan(spark, name)
    assert text.count("FileScan") == 2
    assert "Join" not in text


def test_correlating_a_panel_moves_it_once(spark):
    """From the quarters of a series to its headline row, rows stay where they are."""
    text = plan(spark, "panel_kpi")
    assert len(re.findall(r"hashpartitioning\(l_suppkey#\d+L?, \d+\)", text)) == 1
    assert "hashpartitioning(l_suppkey" in text and "SinglePartition" not in text


def test_only_quarters_are_broadcast(spark):
    text = plan(spark, "panel_fact")
    assert text.count("BroadcastExchange") == 1
    broadcast = text.split("BroadcastExchange")[1].splitlines()[1]
    assert "HashAggregate(keys=[year" in broadcast


def test_a_customer_with_many_orders_is_split(spark):
    """The join on customers, where they are too many to broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        n = F.col("id")
        orders = spark.range(0, 60_000, 1, 6).select(F.when(n % 3 > 0, 1).otherwise(n).alias("c"), n.alias("v"))
        customers = spark.range(0, 60_000).select(n.alias("c"), (n % 25).alias("nation"))
        totals = orders.join(customers, "c").groupBy("nation").agg(F.sum("v").alias("v"))
        found = {r["nation"]: r["v"] for r in totals.collect()}
        final = totals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "skew=true" in final
    assert sum(found.values()) == sum(range(60_000))


@pytest.mark.parametrize("name", sorted(queries.AS_OBSERVED))
def test_rows_that_are_not_resampled_stay_in_many_tasks(spark, name):
    """One row per sorted partition is all that one task sees, where months may repeat."""
    table, make = models.INTERMEDIATE[name]
    made = make(models.stage(table, roles.RAW_TABLES[table](spark, SF_DIR)))
    text = made._jdf.queryExecution().executedPlan().toString()
    for line, following in zip(text.splitlines(), text.splitlines()[1:]):
        if "SinglePartition" in line:
            assert "HashAggregate" in following and "_part" in following


def test_the_latest_row_is_found_without_moving_rows(spark):
    from lagscope.operators import latest_rows

    df = spark.range(0, 100, 1, 4).select(F.col("id").alias("date"), (F.col("id") % 3).alias("k"))
    for keys in ((), ("k",)):
        text = latest_rows(df, keys=keys)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text
        for line, following in zip(text.splitlines(), text.splitlines()[1:]):
            if "SinglePartition" in line:
                assert "HashAggregate" in following
    assert latest_rows(df).count() == 1
    assert {r["date"] for r in latest_rows(df, keys=("k",)).collect()} == {97, 98, 99}


def test_orders_are_summed_before_customers_meet_them(spark):
    text = plan(spark, "panel_quarter_sum")
    assert "LeftOuter" in text
    assert re.search(r"HashAggregate\(keys=\[o_custkey", text.split("Join")[1])


def test_buckets_are_joined_where_they_lie(spark):
    """Below the joins of the fact nothing is shuffled, where the sides are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = queries._desk_buckets(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 4
    joins = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in joins and joins.count("Bucketed: true") == 5
