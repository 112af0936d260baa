"""One date through the star: equal to a full rebuild, however often it is run."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from patronlake.operators.wide import customer_360
from patronlake.plans import daily
from patronlake.sources import keyed

USERS = "user_id string, full_name string, customer_city string, customer_state string, loyalty_tier string"
RAW = {
    "orders": "order_id string, user_id string, total_amount string, order_status string, payment_method string, created_at timestamp_ntz",
    "order_items": "order_id string, order_item_id string, product_id string, price string",
    "events": "event_id string, timestamp timestamp_ntz, user_id string, session_id string, event_type string, "
    "product_id string, device_os string, time_spent_seconds string",
    "tickets": "Ticket_ID string, Order_ID string, Customer_Email string, Issue_Type string, Status string, "
    "Customer_Rating string, Reported_Date timestamp_ntz",
}
DAYS = [dt.date(2025, 3, n) for n in range(1, 6)]


def day_rows(draw, day, n_users=12):
    """What a date delivers; tickets name orders of any date, some of which come later."""
    at = lambda: dt.datetime.combine(day, dt.time(draw.randrange(24), draw.randrange(60)))
    user = lambda: draw.choice([None, *[f"u{i}" for i in range(n_users)]])
    order_ids = [f"o{day.day}-{i}" for i in range(draw.randint(3, 8))]
    return {
        "orders": [(o, user(), f"{draw.randrange(1, 900)}.50", draw.choice(["delivered", "Completed", "shipped"]), None, at()) for o in order_ids],
        "order_items": [(o, str(k), "p1", "3.00") for o in order_ids for k in range(2)],
        "events": [
            (f"e{day.day}-{i}", at(), user(), "s", draw.choice(["view_item", "cart_abandonment", "odd"]), None, None, "3")
            for i in range(draw.randint(0, 9))
        ],
        "tickets": [
            (f"t{day.day}-{i}", draw.choice([None, f"o{draw.randint(1, 5)}-{draw.randint(0, 8)}"]), None,
             draw.choice(["Product Issue", "General Inquiry"]), "Open", "3", at())
            for i in range(draw.randint(0, 8))
        ],
    }


def frames(spark, rows):
    return {name: spark.createDataFrame(rows.get(name, []), kind) for name, kind in RAW.items()}


def users_frame(spark, tier="Gold"):
    return spark.createDataFrame([(f"u{i}", f"name {i}", "c", "s", tier if i % 2 else None) for i in range(10)], USERS)


@pytest.fixture
def star(spark, tmp_path):
    name = f"daily_{uuid.uuid4().hex}"
    yield daily.DailyStar(spark, str(tmp_path), name, buckets=4)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def first_load(spark, star, delivered, users):
    clean = {"orders": daily.clean_orders, "order_items": daily.clean_order_items, "events": daily.clean_events, "tickets": daily.clean_tickets}
    rows = {name: [r for day in delivered for r in delivered[day][name]] for name in RAW}
    parts = {name: clean[name](frame) for name, frame in frames(spark, rows).items()}
    star.load(users, parts["orders"], parts["order_items"], parts["events"], parts["tickets"])


def rebuilt(spark, delivered, users):
    rows = {name: [r for day in delivered for r in delivered[day][name]] for name in RAW}
    raw = frames(spark, rows)
    return content(customer_360(
        users, daily.clean_orders(raw["orders"]), daily.clean_events(raw["events"]), daily.clean_tickets(raw["tickets"])
    ))


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_refreshes_equal_a_full_rebuild(spark, star):
    draw, users = random.Random(3), users_frame(spark)
    delivered = {day: day_rows(draw, day) for day in DAYS[:3]}
    first_load(spark, star, delivered, users)
    assert content(star.wide.read()) == rebuilt(spark, delivered, users)
    for day in (DAYS[3], DAYS[1]):  # a new date, and a corrected one
        delivered[day] = day_rows(draw, day)
        star.refresh(frames(spark, delivered[day]), users, day)
        assert content(star.wide.read()) == rebuilt(spark, delivered, users)
    for table, name, key in (("fact_orders", "orders", 0), ("fact_cs_tickets", "tickets", 0), ("fact_order_items", "order_items", 0)):
        stored = star.facts(table).count()
        assert stored == sum(len(d[name]) for d in delivered.values())


def test_the_same_refresh_again_changes_nothing(spark, star):
    draw, users = random.Random(4), users_frame(spark)
    delivered = {day: day_rows(draw, day) for day in DAYS[:2]}
    first_load(spark, star, delivered, users)
    delivered[DAYS[2]] = day_rows(draw, DAYS[2])
    seen = []
    for _ in range(2):
        star.refresh(frames(spark, delivered[DAYS[2]]), users, DAYS[2])
        seen.append((content(star.wide.read()), content(star.activity.read()), content(star.links.read())))
    assert seen[0] == seen[1] and seen[0][0] == rebuilt(spark, delivered, users)


@pytest.mark.parametrize("dies_at", [0, 2])
def test_a_refresh_that_died_is_run_again(spark, star, monkeypatch, dies_at):
    draw, users = random.Random(5), users_frame(spark)
    delivered = {day: day_rows(draw, day) for day in DAYS[:3]}
    first_load(spark, star, delivered, users)
    delivered[DAYS[1]] = day_rows(draw, DAYS[1])
    calls = []

    def dying(plain):
        def run(*args, **options):
            calls.append(1)
            if len(calls) > dies_at:
                raise RuntimeError("lost driver")
            return plain(*args, **options)

        return run

    with monkeypatch.context() as patched:
        patched.setattr(keyed.KeyedTable, "_publish", dying(keyed.KeyedTable._publish))
        patched.setattr(daily.DailyStar, "_replace_day", dying(daily.DailyStar._replace_day))
        with pytest.raises(RuntimeError):
            star.refresh(frames(spark, delivered[DAYS[1]]), users, DAYS[1])
    star.refresh(frames(spark, delivered[DAYS[1]]), users, DAYS[1])
    assert content(star.wide.read()) == rebuilt(spark, delivered, users)


def test_an_empty_date_and_changed_profiles(spark, star):
    draw, users = random.Random(6), users_frame(spark)
    delivered = {day: day_rows(draw, day) for day in DAYS[:2]}
    first_load(spark, star, delivered, users)
    delivered[DAYS[1]] = {name: [] for name in RAW}  # a recalled date
    changed = users_frame(spark, "Silver")
    star.refresh(frames(spark, {}), changed, DAYS[1])
    assert content(star.wide.read()) == rebuilt(spark, delivered, changed)


def test_only_touched_buckets_are_read(spark, star):
    draw, users = random.Random(7), users_frame(spark)
    first_load(spark, star, {day: day_rows(draw, day) for day in DAYS[:3]}, users)
    touched = users.filter("user_id = 'u3'")
    found = star.activity.rows_of(touched)
    plan = found._jdf.queryExecution().executedPlan().toString()
    own = star.activity._buckets_of(touched)
    assert len(own) == 1 and "PartitionFilters: [isnotnull(bucket" in plan
    names = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert all(f"bucket={min(own)}/" in r.f for r in names)


def test_a_load_evaluates_the_items_once_and_splits_a_day_of_many_rows(spark, star):
    """Ranges by day would evaluate all items for a sample, and again to write them."""
    draw, users = random.Random(8), users_frame(spark)
    delivered = {day: day_rows(draw, day) for day in DAYS}
    many = [(f"h{i}", "u1", "1.50", "delivered", None, dt.datetime.combine(DAYS[2], dt.time(7))) for i in range(400)]
    delivered[DAYS[2]]["orders"] += many
    delivered[DAYS[2]]["order_items"] += [(o[0], "0", "p1", "3.00") for o in many]
    raw = frames(spark, {name: [r for day in DAYS for r in delivered[day][name]] for name in RAW})
    evaluated = spark.sparkContext.accumulator(0)

    def told(key):
        evaluated.add(1)
        return key

    items = daily.clean_order_items(raw["order_items"])
    n_items = items.count()
    orders = daily.clean_orders(raw["orders"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # pieces this small would be joined
    try:
        star.load(
            users, orders, items.withColumn("order_id", F.udf(told)("order_id")), daily.clean_events(raw["events"]),
            daily.clean_tickets(raw["tickets"]),
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert evaluated.value == n_items == star.facts("fact_order_items").count()
    assert content(star.wide.read()) == rebuilt(spark, delivered, users)
    assert [d for days in star._pieces(orders, "created_at").values() for d in days] == [str(DAYS[2])]
    for table, rows in (("fact_orders", "orders"), ("fact_order_items", "order_items")):
        for day in DAYS:
            stored = star.stored(table, day)
            files = stored.select(F.input_file_name().alias("f")).distinct().count()
            assert stored.count() == len(delivered[day][rows]) and (files > 1) == (day == DAYS[2])
