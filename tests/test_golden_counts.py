"""Known counts of the adapted tables at sf0.01, worked out beforehand."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlake.operators import users
from patronlake.plans import serving
from patronlake.sources.bench_tables import BenchStar


@pytest.fixture(scope="module")
def star(spark):
    return BenchStar(spark, "/root/testdata/sf0.01")


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_statuses_and_payments(star):
    assert as_dict(serving.orders_by_status(star)) == {
        "Completed": 6164, "Processing": 3966, "Cancelled": 2559, None: 1298, "Pending": 1013,
    }
    methods = star.fact_orders.groupBy("payment_method").count()
    assert as_dict(methods) == {
        "Bank Slip": 2978, "Credit Card": 2946, "Debit Card": 2966, "Voucher": 2972, None: 3138,
    }
    assert star.fact_orders.filter("user_id IS NULL").count() == 300


def test_events_and_devices(star):
    assert as_dict(serving.events_by_type(star)) == {
        "view_item": 1982, "add_to_cart": 2006, "cart_abandonment": 2014,
    }
    assert as_dict(serving.device_distribution(star)) == {
        "Unknown": 2002, "Android": 1001, "macOS": 1001, "iOS": 999, "Windows": 999,
    }


def test_tickets(star):
    tickets = star.fact_cs_tickets
    assert tickets.filter("customer_email IS NOT NULL").count() == 839
    assert as_dict(serving.tickets_by_category(star)) == {
        "Product Issue": 350, "Positive Feedback": 348, "General Inquiry": 257, "Uncategorized": 45,
    }
    assert as_dict(serving.tickets_by_status(star)) == {"Open": 400, "Unknown": 400, "Resolved": 200}
    assert tickets.filter("order_id IS NOT NULL").count() == 941


def test_products(star):
    assert star.dim_products.filter("cost_price = 0").count() == 40
    assert star.dim_products.filter("category IS NULL").count() == 201
    assert star.fact_order_items.count() == 60_000


@pytest.mark.parametrize(
    "exclude_guests, expected, groups",
    [
        (False, ("1200139.68", "1628512.75", "2021307.85"), 1461),
        (True, ("1198851.53", "1616006.10", "2017470.74"), 1460),
    ],
)
def test_thresholds(star, exclude_guests, expected, groups):
    spend = users.user_spend(star.raw_orders, exclude_guests)
    assert spend.count() == groups
    row = users.loyalty_thresholds(spend).first()
    assert tuple(row) == tuple(Decimal(x) for x in expected)


def test_approximate_thresholds_are_within_one_percent_of_the_ranks(star):
    spend = users.user_spend(star.raw_orders).cache()
    n = spend.count()
    row = users.loyalty_thresholds(spend, relative_error=0.01).first()
    for value, fraction in zip(row, users.TIER_FRACTIONS.values()):
        rank = spend.filter(F.col("total_spend") <= value).count()
        assert abs(rank - fraction * n) <= 0.01 * n + 1


def test_customer_360(star):
    wide = star.customer_360.cache()
    row = wide.agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.sum("total_lifetime_value").alias("ltv"),
        F.sum("total_orders_completed").alias("orders"),
        F.sum("total_abandoned_carts").alias("carts"),
        F.sum("total_cs_complaints").alias("complaints"),
        F.count("last_active_date").alias("active"),
        F.count_if(F.col("loyalty_tier").isNull()).alias("tierless"),
    ).first()
    assert row.asDict() == {
        "rows": 1500, "users": 1500, "ltv": Decimal("1499073006.91"), "orders": 6020,
        "carts": 1912, "complaints": 318, "active": 1463, "tierless": 40,
    }
    known = serving._completed(star).join(star.dim_users, "user_id")
    assert row.ltv == known.agg(F.sum("total_amount")).first()[0]


def test_completed_revenue(star):
    assert serving.total_revenue(star).first()[0] == Decimal("1537411688.51")
