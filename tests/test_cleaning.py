from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions import stamps
from patronlake.functions.vocab import remap
from patronlake.operators import cleaning, events, orders, products, tickets, users


def column(df, name):
    return [row[name] for row in df.collect()]


def test_remap_passes_standard_words_and_drops_the_rest(spark):
    words = ["delivered", "Completed", "completed", "mystery", None, "created"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    out = column(df.select(remap(F.col("w"), S.STATUS_ALIASES, S.ORDER_STATUSES).alias("x")), "x")
    assert out == ["Completed", "Completed", None, None, None, "Pending"]


def test_remap_never_chains(spark):
    df = spark.createDataFrame([("a",), ("b",)], "w string")
    out = column(df.select(remap(F.col("w"), {"a": "b", "b": "c"}, ["b", "c"]).alias("x")), "x")
    assert out == ["b", "c"]


ORDERS = "order_id string, user_id string, total_amount string, order_status string, " \
         "payment_method string, created_at string"


def test_orders_keep_bad_rows_and_quarantine_their_values(spark):
    raw = spark.createDataFrame(
        [
            ("1", None, "10.50", "shipped", "boleto", "2024-01-02 03:04:05"),
            ("2", "u", "1e30", "weird", "cash", "31-12-2024"),
        ],
        ORDERS,
    )
    good, bad = orders.clean_orders(raw).orderBy("order_id").collect()
    assert good.asDict() == {
        "order_id": "1", "user_id": None, "total_amount": Decimal("10.50"),
        "order_status": "Processing", "payment_method": "Bank Slip",
        "created_at": dt.datetime(2024, 1, 2, 3, 4, 5),
    }
    assert (bad.total_amount, bad.order_status, bad.created_at) == (None, None, None)
    plan = orders.orders_plan(raw)
    rejected = cleaning.rejected_values(raw, plan).orderBy("column_name").collect()
    assert [(r.row_key, r.column_name, r.raw_value) for r in rejected] == [
        ("2", "created_at", "31-12-2024"), ("2", "total_amount", "1e30"),
    ]
    drift = {r.column_name: r.unmapped for r in cleaning.drift_counts(raw, plan).collect()}
    assert drift == {"order_status": 1, "payment_method": 1}


def test_keyed_items_without_quantity(spark):
    raw = spark.createDataFrame(
        [("i1", "o1", "p1", 5.5), ("i2", "o1", None, 7.0)],
        "item_id string, order_id string, product_id string, unit_price double",
    )
    rows = orders.clean_order_items(raw).collect()
    assert [(r.item_id, r.quantity, r.unit_price) for r in rows] == [
        ("i1", 1, Decimal("5.50")), ("i2", 1, Decimal("7.00")),
    ]


def test_marketplace_items_get_a_key_and_survive_overflow(spark):
    raw = spark.createDataFrame(
        [("o1", 1, "p", 40_000, "9.99"), ("o1", None, "p", 2, "x")],
        "order_id string, order_item_id int, product_id string, quantity int, price string",
    )
    rows = orders.clean_order_items(raw).collect()
    assert [(r.item_id, r.quantity, r.unit_price) for r in rows] == [
        ("o1_1", None, Decimal("9.99")), ("o1", 2, None),
    ]
    found = cleaning.rejected_values(raw, orders.order_items_plan(raw))
    assert sorted(column(found, "raw_value")) == ["40000", "x"]


def test_products_with_a_cost_pass_through(spark):
    raw = spark.createDataFrame(
        [("p1", "a", None, "3.456"), ("p2", "b", "c", "?")],
        "product_id string, product_name string, category string, cost_price string",
    )
    assert column(products.clean_products(raw), "cost_price") == [Decimal("3.46"), None]


def test_products_without_a_cost_derive_it(spark):
    raw = spark.createDataFrame(
        [("p1", "a", "x"), ("p2", "b", "x")],
        "product_id string, product_name string, category string",
    )
    items = spark.createDataFrame(
        [("p1", "0.10"), ("p1", "0.15"), ("p1", "bad")], "product_id string, price string"
    )
    out = {r.product_id: r.cost_price for r in products.clean_products(raw, items).collect()}
    # 0.7 · 0.125 = 0.0875
    assert out == {"p1": Decimal("0.09"), "p2": Decimal("0.00")}
    with pytest.raises(ValueError):
        products.clean_products(raw)


PROFILE = "user_id string, full_name string, email string, phone_number string, " \
          "customer_city string, customer_state string"


def _user(user_id):
    return (user_id, f"name {user_id}", None, None, "city", "state")


def test_given_tiers_are_validated(spark):
    raw = spark.createDataFrame(
        [(*_user("1"), "Gold", "2024-01-01"), (*_user("2"), "Diamond", "soon")],
        PROFILE + ", loyalty_tier string, created_at string",
    )
    rows = users.clean_users(raw).collect()
    assert [(r.loyalty_tier, r.created_at) for r in rows] == [
        ("Gold", dt.datetime(2024, 1, 1)), (None, None),
    ]


@pytest.mark.parametrize("relative_error", [None, 0.01])
def test_nobody_spent_anything(spark, relative_error):
    raw = spark.createDataFrame([_user("1"), _user("2")], PROFILE)
    sold = spark.createDataFrame([("o", "1", "5", "Pending", None, "2024-05-06")], ORDERS)
    rows = users.clean_users(raw, sold, relative_error=relative_error).orderBy("user_id").collect()
    assert [(r.loyalty_tier, r.created_at) for r in rows] == [
        (None, dt.datetime(2024, 5, 6)), (None, None),
    ]


def test_tier_present_but_no_sign_up_date(spark):
    raw = spark.createDataFrame([(*_user("1"), "Gold")], PROFILE + ", loyalty_tier string")
    sold = spark.createDataFrame([("o", "1", "5", "delivered", None, "2024-05-06")], ORDERS)
    assert column(users.clean_users(raw, sold), "loyalty_tier") == ["Platinum"]


def test_tiers_by_rank_and_guests_count_as_a_spender(spark):
    raw = spark.createDataFrame([_user(str(i)) for i in range(1, 21)], PROFILE)
    sold = spark.createDataFrame(
        [(str(i), str(i), str(i * 10), "Completed", None, "2024-01-01") for i in range(1, 21)]
        + [("g1", None, "500", "delivered", None, "2024-01-01"),
           ("g2", None, "500", "delivered", None, "2024-01-01")],
        ORDERS,
    )
    with_guests = users.loyalty_thresholds(users.user_spend(sold)).first()
    without = users.loyalty_thresholds(users.user_spend(sold, exclude_guests=True)).first()
    # 21 spenders: ranks ceil(13.65), ceil(17.85), ceil(19.95); 20 spenders: 13, 17, 19.
    assert [int(x) for x in with_guests] == [140, 180, 200]
    assert [int(x) for x in without] == [130, 170, 190]
    tiers = {int(r.user_id): r.loyalty_tier for r in users.clean_users(raw, sold).collect()}
    assert (tiers[20], tiers[19], tiers[18], tiers[14], tiers[13]) == (
        "Platinum", "Gold", "Gold", "Silver", "Bronze",
    )


def test_event_stamps(spark):
    raw = spark.createDataFrame(
        [
            ("a", "2024-03-10T02:30:00.123Z", "u", "s", "view_item", None, None, 3),
            ("b", "2024-03-10T02:30:00.123+03:00", None, "s", "add_to_cart", None, None, None),
            ("c", "2024-03-10T02:30:00.123", None, "s", "add_to_cart", None, None, None),
            ("d", "2024-03-10T02:30:00.123Z", None, "s", "purchase", None, None, None),
            ("e", "2024-03-10T02:30:00.123Z", None, "s", None, None, None, None),
        ],
        S.CLICKSTREAM_JSON,
    )
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = {r.event_id: r.timestamp for r in events.clean_events(raw).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert out == {
            "a": dt.datetime(2024, 3, 10, 2, 30, 0, 123000),
            "b": dt.datetime(2024, 3, 9, 23, 30, 0, 123000),
            "c": None,
        }
    rejected = cleaning.rejected_values(raw, events.events_plan(raw)).collect()
    assert [(r.row_key, r.column_name) for r in rejected] == [("c", "timestamp")]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York", "UTC"])
def test_typed_stamps_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on this day does not exist in New York.
    instant = spark.sql("SELECT timestamp_micros(1710037800123456) AS t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moved = instant.select(
            stamps.parse_stamp(F.col("t"), instant.schema["t"].dataType).alias("w")
        )
        back = moved.select(F.unix_micros(stamps.instant_of(F.col("w"))).alias("m")).first().m
        assert moved.first().w == dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
        assert back == 1710037800123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


TICKET_HEAD = "Ticket_ID string, Order_ID string, Customer_Email string, Status string, " \
              "Customer_Rating string, Reported_Date string"


def test_ticket_category_from_rating_alone(spark):
    ratings = ["1", "2", "3", "4", "5", None, "9", "3.0", "bad"]
    raw = spark.createDataFrame(
        [(str(i), None, None, None, r, "2024-01-01") for i, r in enumerate(ratings)], TICKET_HEAD
    )
    rows = tickets.clean_tickets(raw).collect()
    assert [r.issue_category for r in rows] == [
        "Product Issue", "Product Issue", "General Inquiry", "Positive Feedback",
        "Positive Feedback", None, None, "General Inquiry", None,
    ]
    assert [r.rating for r in rows] == [1, 2, 3, 4, 5, None, 9, 3, None]
    rejected = cleaning.rejected_values(raw, tickets.tickets_plan(raw))
    assert column(rejected, "raw_value") == ["bad"]


def test_given_issue_type_wins_when_valid(spark):
    raw = spark.createDataFrame(
        [("1", None, None, None, "1", None, "Positive Feedback"),
         ("2", None, None, None, "1", None, "garbage"),
         ("3", None, None, None, "3", None, None)],
        TICKET_HEAD + ", Issue_Type string",
    )
    assert column(tickets.clean_tickets(raw), "issue_category") == [
        "Positive Feedback", "Product Issue", "General Inquiry",
    ]


def test_emails_and_statuses(spark):
    mails = ["User@Mail.COM", " user@mail.com", "user@mail.com\n", "a@gmal.com", "a.mail.com", None]
    states = [" Open ", "", "  ", None, "Resolved", "Open"]
    raw = spark.createDataFrame(
        [(str(i), None, m, s, None, None) for i, (m, s) in enumerate(zip(mails, states))],
        TICKET_HEAD,
    )
    rows = tickets.clean_tickets(raw).collect()
    assert [r.customer_email for r in rows] == [
        "user@mail.com", None, "user@mail.com\n", "a@gmal.com", None, None,
    ]
    assert [r.status for r in rows] == ["Open", "Unknown", "Unknown", "Unknown", "Resolved", "Open"]
