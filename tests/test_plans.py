"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from patronlake.plans import serving
from patronlake.registry import registered
from patronlake.sources.bench_tables import BenchStar
from patronlake.sources.tables import Zones
from patronlake.operators.wide import customer_360, user_activity

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return BenchStar(spark, SMALL)


@pytest.fixture(scope="module")
def zones(spark, star, tmp_path_factory):
    zones = Zones(spark, str(tmp_path_factory.mktemp("zones")))
    for name in ("dim_users", "fact_orders", "fact_events_log", "fact_cs_tickets", "fact_order_items"):
        zones.write(getattr(star, name), name)
    return zones


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", sorted(k for k in registered() if not k.startswith("stream_")))
def test_no_cross_join_no_python_no_forced_broadcast(star, no_broadcast, key):
    plan = plan_of(registered()[key](star))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "BroadcastHashJoin"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(zones):
    plan = plan_of(serving.revenue_by(zones, "month"))
    assert "EqualTo(order_status,Completed)" in plan
    assert "ReadSchema: struct<total_amount:decimal(18,2),order_status:string,created_at:timestamp_ntz>" in plan


def test_month_range_reaches_the_scan(zones):
    plan = plan_of(serving.orders_by_status(zones, "1997-05"))
    assert "GreaterThanOrEqual(created_at,1997-05-01T00:00)" in plan
    assert "LessThan(created_at,1997-06-01T00:00)" in plan
    assert "ReadSchema: struct<order_status:string,created_at:timestamp_ntz>" in plan


def test_wide_table_aggregates_users_once(zones, no_broadcast):
    plan = plan_of(
        customer_360(zones.dim_users, zones.fact_orders, zones.fact_events_log, zones.fact_cs_tickets)
    )
    by_user = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    by_order = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(by_user) == 2  # users, and all activity together
    assert len(by_order) == 2  # complaints and the orders they name
    assert plan.count("SortMergeJoin") == 2


def test_activity_is_partially_aggregated_before_the_shuffle(zones, no_broadcast):
    lines = plan_of(
        user_activity(zones.fact_orders, zones.fact_events_log, zones.fact_cs_tickets)
    ).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line)
    assert "partial_sum" in lines[exchange + 1]
    # Tickets of one order are folded before they are sent to the join.
    orders = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line]
    assert any("partial_count(ticket_id" in lines[i + 1] for i in orders)


def test_top_products_fold_items_before_the_join(zones, star, no_broadcast):
    lines = plan_of(serving.top_products(star)).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(product_id" in line)
    assert "partial_sum" in lines[exchange + 1]
    assert any("TakeOrderedAndProject" in line for line in lines)


def test_first_row_per_key_is_cut_before_the_shuffle(star):
    lines = plan_of(registered()["stg_customers"](star)).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "hashpartitioning(customer_unique_id" in line)
    assert "WindowGroupLimit" in lines[exchange + 1] and "Partial" in lines[exchange + 1]


def test_a_hot_order_is_split_when_its_items_meet_the_month(spark, no_broadcast):
    """A third of all items in one order: adaptive execution splits that order's partition."""
    star = SimpleNamespace(
        fact_orders=spark.range(20_000).select(
            F.col("id").cast("string").alias("order_id"),
            F.lit("1997-05-05 00:00:00").cast("timestamp_ntz").alias("created_at"),
        ),
        fact_order_items=spark.range(0, 600_000, 1, 16).select(
            F.expr("CASE WHEN id % 3 = 0 THEN '7' ELSE CAST(id % 20000 AS STRING) END").alias("order_id"),
            F.col("id").cast("string").alias("product_id"),
            F.lit(1).cast("short").alias("quantity"),
            F.lit(2).cast("decimal(12,2)").alias("unit_price"),
        ),
        dim_products=spark.range(600_000).select(
            F.col("id").cast("string").alias("product_id"),
            F.lit("n").alias("product_name"), F.lit("c").alias("category"),
        ),
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = serving.top_products(star, "1997-05")
        (row,) = df.collect()
        plan = plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert (row.revenue, row.units_sold) == (1_200_000, 600_000)
    assert "SortMergeJoin(skew=true) [order_id" in plan
