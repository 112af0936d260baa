from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions import labels, periods
from patronlake.operators import events as feed
from patronlake.operators import wide
from patronlake.plans import serving


def fact_orders(spark, *rows):
    return spark.createDataFrame(
        [(o, u, Decimal(a), s, p, dt.datetime.fromisoformat(c)) for o, u, a, s, p, c in rows],
        "order_id string, user_id string, total_amount decimal(18,2), order_status string, "
        "payment_method string, created_at timestamp_ntz",
    )


@pytest.fixture(scope="module")
def star(spark):
    orders = fact_orders(
        spark,
        ("1", "a", "10", "Completed", "Voucher", "2024-01-31T23:59:59"),
        ("2", "a", "20", "Completed", None, "2024-02-01T00:00:00"),
        ("3", None, "40", "Completed", "Voucher", "2025-02-01T00:00:00"),
        ("4", "b", "80", None, "Voucher", "2024-02-29T12:00:00"),
    )
    items = spark.createDataFrame(
        [("i1", "1", "p1", 2, Decimal("1.50")), ("i2", "2", "p2", 1, Decimal("4")),
         ("i3", "4", "p3", 3, Decimal("9")), ("i4", "9", None, 3, Decimal("9"))],
        "item_id string, order_id string, product_id string, quantity short, unit_price decimal(12,2)",
    )
    products = spark.createDataFrame(
        [("p1", "same", None, Decimal(1)), ("p2", "same", None, Decimal(1)), ("p3", "z", "c", Decimal(1))],
        S.DIM_PRODUCTS.schema,
    )
    users = spark.createDataFrame(
        [("a", "João Silva", "SP", None), ("b", "100% Ana_B", "RJ", "Gold"), ("c", "ana xb", "SP", None)],
        "user_id string, full_name string, customer_state string, loyalty_tier string",
    )
    wide_table = users.select(
        "user_id", "full_name", F.lit("x").alias("customer_city"), "customer_state", "loyalty_tier",
        F.lit(1).cast("decimal(18,2)").alias("total_lifetime_value"),
        F.lit(None).cast("float").alias("churn_risk_score"),
    )
    return SimpleNamespace(
        fact_orders=orders, fact_order_items=items, dim_products=products, dim_users=users,
        customer_360=wide_table,
    )


def test_periods(star):
    days = [(str(r.period), int(r.revenue)) for r in serving.revenue_by(star, "day").collect()]
    assert days == [("2024-01-31", 10), ("2024-02-01", 20), ("2025-02-01", 40)]
    years = [(str(r.period), int(r.revenue)) for r in serving.revenue_by(star, "year").collect()]
    assert years == [("2024-01-01", 30), ("2025-01-01", 40)]
    for granularity, label in (("month", "2024-01"), ("year", "2024"), ("day", "2024-01-31")):
        assert serving.revenue_by_label(star, granularity).first().label == label
    with pytest.raises(ValueError):
        serving.revenue_by(star, "week")


@pytest.mark.parametrize("month", ["2024-02", "2024-02-01", dt.date(2024, 2, 17)])
def test_month_filter(star, month):
    assert [tuple(r) for r in serving.orders_by_status(star, month).collect()] == [
        ("Completed", 1), (None, 1),
    ]
    assert [int(r.revenue) for r in serving.revenue_by_payment(star, month).collect()] == [80]
    assert [r.product_name for r in serving.top_products(star, month).collect()] == ["z", "same"]


def test_no_month_means_all(star):
    assert sum(r.cnt for r in serving.orders_by_status(star).collect()) == 4
    assert periods.month_bounds("2023-12") == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))


def test_products_of_one_name_merge(star):
    found = [(r.product_name, r.revenue, r.units_sold) for r in serving.top_products(star).collect()]
    assert found == [("z", Decimal("27.00"), 3), ("same", Decimal("7.00"), 3)]


def test_guest_orders_have_no_state(star):
    assert [tuple(r) for r in serving.top_states(star).collect()] == [("SP", Decimal("30.00"), 2)]


def test_tier_order(star):
    assert [tuple(r) for r in serving.loyalty_distribution(star).collect()] == [
        ("Gold", 1), ("No Tier", 2),
    ]


@pytest.mark.parametrize(
    "term, hits",
    [("joão", ["a"]), ("ANA", ["b", "c"]), ("ana_b", ["b"]), ("ana _b", ["c"]), ("0%a", ["b"]), ("nobody", [])],
)
def test_search(star, term, hits):
    assert [r.user_id for r in serving.customer_360_search(star, term).collect()] == hits


def test_pages_cover_all_rows_once(star):
    pages = [serving.customer_360_page(star, 1, i).first().user_id for i in range(3)]
    assert pages == ["a", "b", "c"]
    assert "churn_risk_score" not in serving.customer_360_page(star).columns


def test_revenue_of_nothing_is_zero(star):
    empty = SimpleNamespace(fact_orders=star.fact_orders.limit(0))
    assert serving.total_revenue(empty).first()[0] == 0


def test_labels(spark):
    cases = {
        None: ("0", "R$ 0"), 0: ("0", "R$ 0.00"), 999: ("999", "R$ 999.00"),
        1000: ("1.0K", "R$ 1.0K"), 1150: ("1.1K", "R$ 1.1K"), 1250: ("1.2K", "R$ 1.2K"),
        1_000_000: ("1.0M", "R$ 1.00M"), 1_234_567_890: ("1234.6M", "R$ 1234.57M"),
    }
    df = spark.createDataFrame([(n,) for n in cases], "n long")
    rows = df.select(labels.number_label(F.col("n")), labels.currency_label(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == list(cases.values())


def test_last_active_date_and_duplicate_tickets(spark):
    users = spark.createDataFrame(
        [(u, u, "c", "s", None) for u in ("order", "event", "both", "none")],
        "user_id string, full_name string, customer_city string, customer_state string, loyalty_tier string",
    )
    orders = fact_orders(
        spark,
        ("1", "order", "1", "Completed", None, "2024-01-01T00:00:00"),
        ("2", "both", "2", "Completed", None, "2024-01-05T00:00:00"),
        ("3", "both", "4", "Pending", None, "2024-06-01T00:00:00"),
        ("4", None, "8", "Completed", None, "2024-06-01T00:00:00"),
    )
    stamps = [("a", "event", "view_item", "2024-02-02"), ("b", "both", "cart_abandonment", "2024-01-03"),
              ("c", None, "cart_abandonment", "2024-09-09")]
    log = spark.createDataFrame(stamps, "event_id string, user_id string, event_type string, t string")
    log = log.withColumn("timestamp", F.col("t").cast("timestamp_ntz"))
    tickets = spark.createDataFrame(
        [("t1", "2", "Product Issue"), ("t1", "2", "Product Issue"), ("t2", "2", "General Inquiry"),
         ("t3", None, "Product Issue"), ("t4", "99", "Product Issue"), ("t5", "3", "Product Issue")],
        "ticket_id string, order_id string, issue_category string",
    )
    found = {r.user_id: r for r in wide.customer_360(users, orders, log, tickets).collect()}
    assert {u: r.last_active_date for u, r in found.items()} == {
        "order": dt.datetime(2024, 1, 1), "event": dt.datetime(2024, 2, 2),
        "both": dt.datetime(2024, 1, 5), "none": None,
    }
    both = found["both"]
    assert (both.total_lifetime_value, both.total_orders_completed, both.total_abandoned_carts,
            both.total_cs_complaints) == (Decimal("2.00"), 1, 1, 3)
    assert found["none"].total_lifetime_value == 0 and found["none"].churn_risk_score is None


def raw_events(spark):
    return spark.createDataFrame(
        [(f"e{i}", f"2024-01-0{1 + i // 2}T00:00:00.000Z", "view_item") for i in range(6)],
        "event_id string, timestamp string, event_type string",
    )


def test_pages_of_the_feed(spark):
    raw = raw_events(spark)
    page = feed.events_page(raw, limit=2, offset=1, since="2024-01-02").collect()
    assert [(r.event_id, r.total, r.has_more) for r in page] == [("e3", 4, True), ("e4", 4, True)]
    last = feed.events_page(raw, limit=2, offset=4).collect()
    assert [(r.event_id, r.has_more) for r in last] == [("e4", False), ("e5", False)]
    for limit, offset in ((0, 0), (10_001, 0), (1, -1)):
        with pytest.raises(ValueError):
            feed.events_page(raw, limit, offset)


def test_walk_through_the_feed(spark):
    raw, position, seen = raw_events(spark), None, []
    while page := feed.events_after(raw, position, limit=4).collect():
        seen += [r.event_id for r in page]
        position = (page[-1].timestamp, page[-1].event_id)
    assert seen == [f"e{i}" for i in range(6)]
