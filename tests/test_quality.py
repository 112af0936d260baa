from __future__ import annotations

import pytest

from patronlake.operators import quality
from patronlake.operators.quality import CONTRACTS
from patronlake.sources.bench_tables import BenchStar

USER = dict(
    user_id="u1", full_name="A B", email="a@b.co", phone_number="1", customer_city="c",
    customer_state="s", loyalty_tier="Gold", created_at="2024-01-01 00:00:00",
)
PRODUCT = dict(product_id="p", product_name="n", category="c", cost_price="49.90")
ORDER = dict(
    order_id="o", user_id="u", total_amount="10", order_status="Completed",
    payment_method="Credit Card", created_at="2024-01-01 00:00:00",
)
EVENT = dict(
    event_id="e", timestamp="2024-01-01T00:00:00.123", user_id=None, session_id="s",
    event_type="view_item", product_id=None, device_os=None, time_spent_seconds="5",
)
CASES = [
    ("dim_users", USER, {}, True),
    ("dim_users", USER, dict(email=None, phone_number=None, loyalty_tier=None), True),
    ("dim_users", USER, dict(full_name=None, customer_city=None), False),
    ("dim_users", USER, dict(loyalty_tier="Diamond"), False),
    ("dim_products", PRODUCT, {}, True),
    ("dim_products", PRODUCT, dict(cost_price="-10"), False),
    ("fact_orders", ORDER, {}, True),
    ("fact_orders", ORDER, dict(order_status="shipped"), False),
    ("fact_events_log", EVENT, {}, True),
    ("fact_events_log", EVENT, dict(event_type="purchase"), False),
]


def one_row(spark, table, record):
    spec = CONTRACTS[table].spec
    raw = spark.createDataFrame([record], ", ".join(f"`{c}` string" for c in record))
    return raw.select(*[
        raw[c].cast(spec.schema[c].dataType).alias(c) if c in spec.columns else raw[c]
        for c in record
    ])


@pytest.mark.parametrize("table, record, change, accepted", CASES)
def test_records(spark, table, record, change, accepted):
    df = one_row(spark, table, {**record, **change})
    assert quality.schema_faults(df, CONTRACTS[table]) == []
    assert (quality.row_faults(df, CONTRACTS[table]).count() == 0) is accepted


def test_missing_extra_and_mistyped_columns(spark):
    df = spark.createDataFrame([("u1", 5, "x")], "user_id string, full_name int, extra string")
    faults = quality.schema_faults(df, CONTRACTS["dim_users"])
    assert "customer_city is missing" in faults and "created_at is missing" in faults
    assert "extra is not part of the contract" in faults
    assert "full_name is int, not string" in faults
    assert not any("email" in f for f in faults)


def test_broken_rules_are_named(spark):
    df = one_row(spark, "fact_orders", {**ORDER, "order_status": None, "total_amount": "-1"})
    (row,) = quality.row_faults(df, CONTRACTS["fact_orders"]).collect()
    assert sorted(row.broken_rules) == [
        "order_status in vocabulary", "order_status required", "total_amount at least 0",
    ]


def test_reports_read_each_table_once(spark):
    star = BenchStar(spark, "/root/testdata/sf0.001")
    report = quality.contract_report(star, ["fact_cs_tickets", "fact_events_log"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_clean_tables_meet_their_schema_contract(spark):
    star = BenchStar(spark, "/root/testdata/sf0.001")
    for name, contract in CONTRACTS.items():
        assert quality.schema_faults(getattr(star, name), contract) == []
