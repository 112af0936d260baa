"""Serving queries over the star schema.

Each takes a ``star``, anything with the seven tables as attributes, and returns a DataFrame. A
``month`` of None means all months. NULL groups sort last, and every top-k and page has a unique
tie-breaker, so results are repeatable.
"""

from __future__ import annotations

import datetime as dt
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.labels import currency_label, number_label
from patronlake.functions.periods import in_month, period_label, period_start
from patronlake.functions.text import contains_pattern
from patronlake.functions.vocab import label_null

Month = str | dt.date | None


class Star(Protocol):
    dim_users: DataFrame
    dim_products: DataFrame
    fact_orders: DataFrame
    fact_order_items: DataFrame
    fact_events_log: DataFrame
    fact_cs_tickets: DataFrame
    customer_360: DataFrame


def _count() -> Column:
    return F.count("*")


def _money(column: Column | str) -> Column:
    return F.sum(column).cast(S.MONEY_TOTAL)


def _completed(star: Star) -> DataFrame:
    return star.fact_orders.filter(F.col("order_status") == S.COMPLETED)


def _count_by(df: DataFrame, **dimensions: Column) -> DataFrame:
    """Rows per dimension. Grouping is by the expression itself, never by a column it shadows."""
    return df.select(*[c.alias(name) for name, c in dimensions.items()]).groupBy(*dimensions).agg(
        _count().alias("cnt")
    )


def _largest_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(t) for t in ties])


# KPIs ----------------------------------------------------------------------------------------


def total_customers(star: Star) -> DataFrame:
    return star.dim_users.agg(_count().alias("total_customers"))


def total_orders(star: Star) -> DataFrame:
    return star.fact_orders.agg(_count().alias("total_orders"))


def total_revenue(star: Star) -> DataFrame:
    revenue = F.coalesce(_money("total_amount"), F.lit(0).cast(S.MONEY_TOTAL))
    return _completed(star).agg(revenue.alias("total_revenue"))


def total_events(star: Star) -> DataFrame:
    return star.fact_events_log.agg(_count().alias("total_events"))


def total_tickets(star: Star) -> DataFrame:
    return star.fact_cs_tickets.agg(_count().alias("total_tickets"))


def total_products(star: Star) -> DataFrame:
    return star.dim_products.agg(_count().alias("total_products"))


def kpi_overview(star: Star) -> DataFrame:
    """The six KPIs and their card labels as one row."""
    row = total_customers(star)
    for kpi in (total_orders, total_revenue, total_events, total_tickets, total_products):
        row = row.withColumn(kpi.__name__, kpi(star).scalar())
    names = row.columns
    return row.withColumns({
        f"{name}_label": (currency_label if name == "total_revenue" else number_label)(F.col(name))
        for name in names
    })


# Orders --------------------------------------------------------------------------------------


def revenue_by(star: Star, granularity: str = "month") -> DataFrame:
    period = period_start(F.col("created_at"), granularity)
    return (
        _completed(star)
        .groupBy(period.alias("period"))
        .agg(_money("total_amount").alias("revenue"), _count().alias("order_count"))
        .orderBy(F.asc_nulls_last("period"))
    )


def revenue_by_label(star: Star, granularity: str = "month") -> DataFrame:
    """Revenue series with the axis label of the period."""
    return revenue_by(star, granularity).withColumn(
        "label", period_label(F.col("period"), granularity)
    )


def orders_by_status(star: Star, month: Month = None) -> DataFrame:
    orders = in_month(star.fact_orders, "created_at", month)
    counts = _count_by(orders, order_status=F.col("order_status"))
    return _largest_first(counts, "cnt", "order_status")


def revenue_by_payment(star: Star, month: Month = None) -> DataFrame:
    """Every order status counts; orders without a known method do not."""
    orders = in_month(star.fact_orders, "created_at", month)
    by_method = (
        orders.filter(F.col("payment_method").isNotNull())
        .groupBy("payment_method")
        .agg(_money("total_amount").alias("revenue"), _count().alias("order_count"))
    )
    return _largest_first(by_method, "revenue", "payment_method")


def top_products(star: Star, month: Month = None, k: int = 10) -> DataFrame:
    """Best sellers by name and category; products of equal name and category are one.

    Items are first folded to one row per product, so a product that holds a third of all items
    brings one row to the join with the products.
    """
    items = star.fact_order_items.filter(F.col("product_id").isNotNull())
    if month is not None:
        in_window = in_month(star.fact_orders, "created_at", month).select("order_id")
        items = items.join(in_window, "order_id")
    line = F.col("unit_price") * F.col("quantity")
    per_product = items.groupBy("product_id").agg(
        F.sum(line).alias("revenue"), F.sum("quantity").alias("units_sold")
    )
    by_name = (
        per_product.join(star.dim_products, "product_id")
        .groupBy("product_name", "category")
        .agg(_money("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold"))
    )
    return _largest_first(by_name, "revenue", "product_name", "category").limit(k)


def top_states(star: Star, k: int = 10) -> DataFrame:
    """Completed revenue by customer state; guest orders have no state and drop out.

    Orders are folded to one row per user before they meet the users.
    """
    per_user = (
        _completed(star)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("total_amount").alias("revenue"), _count().alias("order_count"))
    )
    by_state = (
        per_user.join(star.dim_users.select("user_id", "customer_state"), "user_id")
        .groupBy("customer_state")
        .agg(_money("revenue").alias("revenue"), F.sum("order_count").alias("order_count"))
    )
    return _largest_first(by_state, "revenue", "customer_state").limit(k)


# Customers -----------------------------------------------------------------------------------


def loyalty_distribution(star: Star) -> DataFrame:
    counts = _count_by(star.dim_users, tier=label_null(F.col("loyalty_tier"), "No Tier"))
    rank = F.lit(len(S.LOYALTY_TIERS) + 1)
    for position, tier in enumerate(reversed(S.LOYALTY_TIERS), start=1):
        rank = F.when(F.col("tier") == tier, position).otherwise(rank)
    return counts.orderBy(rank, "tier")


def _customer_rows(star: Star) -> DataFrame:
    return star.customer_360.drop("churn_risk_score")


def customer_360_page(star: Star, limit: int = 100, offset: int = 0) -> DataFrame:
    return (
        _largest_first(_customer_rows(star), "total_lifetime_value", "user_id")
        .offset(offset)
        .limit(limit)
    )


def customer_360_count(star: Star) -> DataFrame:
    return star.customer_360.agg(_count().alias("total_customers"))


def customer_360_search(star: Star, term: str, k: int = 50) -> DataFrame:
    pattern = contains_pattern(term)
    hits = _customer_rows(star).filter(
        F.col("full_name").ilike(pattern) | F.col("user_id").ilike(pattern)
    )
    return _largest_first(hits, "total_lifetime_value", "user_id").limit(k)


# Events --------------------------------------------------------------------------------------


def events_by_type(star: Star, month: Month = None) -> DataFrame:
    events = in_month(star.fact_events_log, "timestamp", month)
    return _largest_first(_count_by(events, event_type=F.col("event_type")), "cnt", "event_type")


def events_by_day(star: Star, month: Month = None) -> DataFrame:
    events = in_month(star.fact_events_log, "timestamp", month)
    counts = _count_by(events, day=F.to_date("timestamp"), event_type=F.col("event_type"))
    return counts.orderBy(F.asc_nulls_last("day"), "event_type")


def device_distribution(star: Star) -> DataFrame:
    """NULL devices and the literal word 'Unknown' are one group."""
    device = label_null(F.col("device_os"), "Unknown")
    return _largest_first(_count_by(star.fact_events_log, device_os=device), "cnt", "device_os")


# Tickets -------------------------------------------------------------------------------------


def tickets_by_category(star: Star, month: Month = None) -> DataFrame:
    tickets = in_month(star.fact_cs_tickets, "reported_at", month)
    counts = _count_by(tickets, category=label_null(F.col("issue_category"), "Uncategorized"))
    return _largest_first(counts, "cnt", "category")


def tickets_by_status(star: Star, month: Month = None) -> DataFrame:
    tickets = in_month(star.fact_cs_tickets, "reported_at", month)
    return _largest_first(_count_by(tickets, status=F.col("status")), "cnt", "status")


def tickets_by_day(star: Star, month: Month = None) -> DataFrame:
    tickets = in_month(star.fact_cs_tickets, "reported_at", month)
    return _count_by(tickets, day=F.to_date("reported_at")).orderBy(F.asc_nulls_last("day"))


def avg_rating_by_month(star: Star) -> DataFrame:
    """Average rounded half to even, as the serving database rounds floats."""
    mean = F.sum("rating").cast("double") / F.count("rating")
    return (
        star.fact_cs_tickets.filter(F.col("rating").isNotNull())
        .groupBy(period_start(F.col("reported_at"), "month").alias("month"))
        .agg(F.bround(mean, 2).alias("avg_rating"), _count().alias("ticket_count"))
        .orderBy(F.asc_nulls_last("month"))
    )


# Month pickers -------------------------------------------------------------------------------


def _months(df: DataFrame, stamp: str) -> DataFrame:
    month = period_start(F.col(stamp), "month").alias("month")
    return df.select(month).distinct().orderBy(F.desc_nulls_last("month"))


def available_order_months(star: Star) -> DataFrame:
    return _months(star.fact_orders, "created_at")


def available_event_months(star: Star) -> DataFrame:
    return _months(star.fact_events_log, "timestamp")


def available_ticket_months(star: Star) -> DataFrame:
    return _months(star.fact_cs_tickets, "reported_at")
