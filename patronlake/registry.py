"""Every operator as a named query over a directory of benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake import parameters as P
from patronlake import schemas as S
from patronlake.functions.periods import yyyymm
from patronlake.operators import cleaning, events, funnel, orders, quality, staging, tickets, users, wide
from patronlake.operators.products import cost_prices, products_plan
from patronlake.plans import serving
from patronlake.plans.daily import DailyStar
from patronlake.sources.keyed import KeyedTable
from patronlake.sources.landing import ingest_counts
from patronlake.sources.ranked import RANK, RankedTable
from patronlake.sources.shapes import RAW_SHAPES
from patronlake.sources.tables import Warehouse, newest_by_key
from patronlake.sources.bench_tables import BenchStar
from patronlake.streaming import feed
from patronlake.streaming.scratch import scratch_folder

Query = Callable[[BenchStar], DataFrame]


def _tables() -> dict[str, Query]:
    named = {name: (lambda t, name=name: getattr(t, name)) for name in S.TABLES}
    return {
        **named,
        "dim_users_validated": lambda t: users.clean_users(t.raw("raw_tiered_users")),
        "user_spend": lambda t: users.user_spend(t.raw_orders),
        "loyalty_thresholds": lambda t: users.loyalty_thresholds(users.user_spend(t.raw_orders)),
        "loyalty_thresholds_no_guests": lambda t: users.loyalty_thresholds(
            users.user_spend(t.raw_orders, exclude_guests=True)
        ),
        "loyalty_thresholds_approx": lambda t: users.thresholds_in_range(
            users.user_spend(t.raw_orders),
            users.loyalty_thresholds(users.user_spend(t.raw_orders), relative_error=0.01),
            error=0.01,
        ),
        "product_cost": lambda t: cost_prices(t.raw_order_items),
        "order_agg_by_user": lambda t: wide.purchases_by_user(_activity(t)),
        "abandoned_carts_by_user": lambda t: wide.carts_by_user(_activity(t)),
        "last_event_by_user": lambda t: wide.last_seen_by_user(_activity(t)),
        "complaints_by_user": lambda t: wide.complaints_by_user(_activity(t)),
        "quarantine": _quarantine,
        "remap_drift": _remap_drift,
    }


def _activity(t: BenchStar) -> DataFrame:
    return wide.user_activity(t.fact_orders, t.fact_events_log, t.fact_cs_tickets)


def _quarantine(t: BenchStar) -> DataFrame:
    plans = [
        (t.raw("text_users"), users.users_plan),
        (t.raw("text_products"), lambda _: products_plan()),
        (t.raw("text_orders"), orders.orders_plan),
        (t.raw("text_order_items"), orders.order_items_plan),
        (t.raw("text_events"), events.events_plan),
        (t.raw_tickets, tickets.tickets_plan),
    ]
    return reduce(
        DataFrame.unionByName, [cleaning.rejected_values(raw, plan(raw)) for raw, plan in plans]
    )


def _remap_drift(t: BenchStar) -> DataFrame:
    tiered = t.raw("raw_tiered_users")
    return cleaning.drift_counts(t.raw_orders, orders.orders_plan(t.raw_orders)).unionByName(
        cleaning.drift_counts(tiered, users.users_plan(tiered))
    )


def _loads(t: BenchStar) -> tuple[DataFrame, DataFrame]:
    """A full load, then a second one of the buying customers with their tiers revised."""
    revised = users.clean_users(t.raw("raw_tiered_users")).select("user_id", "loyalty_tier")
    second = (
        t.customer_360.filter("total_orders_completed > 0")
        .drop("loyalty_tier")
        .join(revised, "user_id", "left")
    )
    return t.customer_360, second


def _upsert(t: BenchStar) -> DataFrame:
    first, second = (rows.withColumn("load_seq", F.lit(i)) for i, rows in enumerate(_loads(t)))
    return newest_by_key(first.unionByName(second), "user_id")


def _stream_clean(t: BenchStar) -> DataFrame:
    folder = scratch_folder(t.spark)
    cleaned = feed.clean_event_stream(_event_stream(t))
    feed.write_events(cleaned, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(cleaned.schema).parquet(f"{folder}/events")


def _stream_deduplicated(t: BenchStar) -> DataFrame:
    """The feed posted twice, as a client that retries would."""
    folder = scratch_folder(t.spark)
    cleaned = feed.clean_event_stream(_event_stream(t))
    once = feed.deduplicated(cleaned.unionByName(feed.clean_event_stream(_event_stream(t))), "36500 days")
    feed.write_events(once, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(once.schema).parquet(f"{folder}/events").select(*cleaned.columns)


def _new_events(t: BenchStar) -> DataFrame:
    """What a pull brings after all events before the parameter's stamp were loaded."""
    loaded = t.fact_events_log.filter(F.col("timestamp") < F.lit(P.EVENTS_SINCE).cast("timestamp_ntz"))
    return feed.new_events(t.fact_events_log, loaded)


def _load_rejects(t: BenchStar) -> DataFrame:
    """Rows that a load sets apart: orders of unknown status."""
    warehouse = Warehouse(t.spark, f"rejects_{uuid.uuid4().hex}")
    warehouse.load(t.fact_orders, S.TABLES["fact_orders"], on_null="quarantine")
    return warehouse.rejects("fact_orders")


def _stream_days(t: BenchStar) -> DataFrame:
    folder = scratch_folder(t.spark)
    counts = feed.counts_by_day(feed.clean_event_stream(_event_stream(t)), "1 day")
    feed.write_day_counts(counts, f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return feed.read_day_counts(t.spark, f"{folder}/days")


def _event_stream(t: BenchStar) -> DataFrame:
    """The events table read as a file stream, in the feed's shape.

    The braces make the path a pattern, which a file stream takes whether the table is one file or
    a folder of files.
    """
    stored = t.source("events").schema
    stream = t.spark.readStream.schema(stored).parquet(f"{t.directory}/{{events.parquet}}")
    return stream.selectExpr(*[f"{e} AS `{n}`" for n, e in RAW_SHAPES["raw_events"][1].items()])


def _daily_refresh(t: BenchStar) -> DataFrame:
    """A first load without two dates, then these dates one after the other."""
    folder = scratch_folder(t.spark)
    star = DailyStar(t.spark, folder, f"daily_{uuid.uuid4().hex}", buckets=16)

    def before(rows: DataFrame, stamp: str) -> DataFrame:
        day = F.to_date(stamp)
        return rows.filter(day.isNull() | ~day.isin(*P.REFRESH_DAYS))

    orders = before(t.fact_orders, "created_at")
    star.load(
        users.clean_users(t.raw_users, before(t.raw_orders, "created_at")), orders,
        t.fact_order_items.join(orders.select("order_id"), "order_id", "left_semi"),
        before(t.fact_events_log, "timestamp"), before(t.fact_cs_tickets, "reported_at"),
    )
    raw = {name: getattr(t, f"raw_{name}") for name in ("orders", "order_items", "events", "tickets")}
    # The tiers come from all orders; both dates take the same users.
    t.dim_users.write.parquet(f"{folder}/dim_users")
    profiles = t.spark.read.schema(S.DIM_USERS.schema).parquet(f"{folder}/dim_users")
    for day in P.REFRESH_DAYS:
        star.refresh(raw, profiles, day)
    return star.wide.read()


def _merge_by_key(t: BenchStar) -> DataFrame:
    """The two loads of ``customer_360_upsert`` as merges into a table in buckets."""
    first, second = _loads(t)
    table = KeyedTable(
        t.spark, f"keyed_{uuid.uuid4().hex}", "customer_360", S.CUSTOMER_360.schema, "user_id", buckets=16
    )
    table.merge(first)
    table.merge(second)
    return table.read()


def _customers_middle_page(t: BenchStar) -> DataFrame:
    """The page that begins half-way through the customers, from a table with a directory of ranks."""
    table = RankedTable(
        t.spark, f"ranked_{uuid.uuid4().hex}", "customers", [("total_lifetime_value", True), ("user_id", False)]
    )
    rows = table.load(t.customer_360.drop("churn_risk_score"))
    return table.page(rows // 2, P.PAGE_LIMIT).drop(RANK)


def _events_deep_page(t: BenchStar) -> DataFrame:
    table = RankedTable(t.spark, f"ranked_{uuid.uuid4().hex}", "events", [("timestamp", False), ("event_id", False)])
    table.load(t.raw_events)
    return table.page_from((P.EVENTS_SINCE,), P.EVENTS_DEEP, P.EVENTS_LIMIT).drop(RANK)


def _feeds() -> dict[str, Query]:
    return {
        "ingest_counts": lambda t: ingest_counts({
            name: t.raw(f"raw_{name}") for name in ("users", "products", "orders", "order_items")
        }),
        "raw_event_count": lambda t: events.event_count(t.raw_events),
        "events_page": lambda t: events.events_page(
            t.raw_events, P.EVENTS_LIMIT, P.EVENTS_OFFSET, P.EVENTS_SINCE
        ),
        "events_since": lambda t: events.events_since(t.raw_events, P.EVENTS_SINCE),
        "latest_events": lambda t: events.latest_events(t.fact_events_log),
        "latest_type_counts": lambda t: events.latest_type_counts(t.fact_events_log),
        "session_funnel": lambda t: events.session_funnel(t.fact_events_log),
        "ordered_funnel": lambda t: funnel.ordered_funnel(t.fact_events_log),
        "events_deep_page": _events_deep_page,
        "customers_middle_page": _customers_middle_page,
        "orders_by_yyyymm": lambda t: t.fact_orders.groupBy(
            yyyymm(F.col("created_at")).alias("yyyymm")
        ).agg(F.count("*").alias("order_count")),
        "customer_360_upsert": _upsert,
        "merge_by_key": _merge_by_key,
        "daily_refresh": _daily_refresh,
        "stream_clean_events": _stream_clean,
        "stream_events_by_day": _stream_days,
        "stream_deduplicated": _stream_deduplicated,
        "new_events": _new_events,
        "load_rejects": _load_rejects,
    }


def _serving() -> dict[str, Query]:
    plain = (
        "total_customers", "total_orders", "total_revenue", "total_events", "total_tickets",
        "total_products", "kpi_overview", "orders_by_status", "revenue_by_payment",
        "top_products", "loyalty_distribution", "events_by_type", "events_by_day",
        "device_distribution", "tickets_by_category", "tickets_by_status", "tickets_by_day",
        "available_order_months", "available_event_months", "available_ticket_months",
        "customer_360_count", "top_states", "avg_rating_by_month",
    )
    in_month = {
        P.ORDER_MONTH: ("orders_by_status", "revenue_by_payment", "top_products"),
        P.EVENT_MONTH: ("events_by_type", "events_by_day"),
        P.TICKET_MONTH: ("tickets_by_category", "tickets_by_status", "tickets_by_day"),
    }
    found: dict[str, Query] = {name: getattr(serving, name) for name in plain}
    for month, names in in_month.items():
        for name in names:
            found[f"{name}_in_month"] = (
                lambda t, name=name, month=month: getattr(serving, name)(t, month)
            )
    for period in ("day", "month", "year"):
        found[f"revenue_by_{period}"] = lambda t, period=period: serving.revenue_by(t, period)
    found["revenue_by_month_label"] = lambda t: serving.revenue_by_label(t, "month")
    found["customer_360_page"] = lambda t: serving.customer_360_page(
        t, P.PAGE_LIMIT, P.PAGE_OFFSET
    )
    found["customer_360_search"] = lambda t: serving.customer_360_search(t, P.SEARCH_TERM)
    return found


def _quality() -> dict[str, Query]:
    return {
        "contract_report": quality.contract_report,
        "dq_report": quality.dq_report,
        "not_null_violations": quality.not_null_report,
        "email_quality": lambda t: staging.email_quality(t.raw_tickets),
        "distinct_ids": lambda t: staging.distinct_ids(t.raw_orders, "user_id"),
        "order_value_profile": lambda t: staging.order_value_profile(
            t.fact_orders, t.fact_order_items
        ),
    }


def _staging() -> dict[str, Query]:
    def people(t: BenchStar) -> DataFrame:
        ids = t.market("mk_customers").select(F.col("customer_unique_id").alias("user_id"))
        return ids.distinct()

    def sources(t: BenchStar, *names: str) -> list[DataFrame]:
        return [t.market(f"mk_{name}") for name in names]

    return {
        "stg_customers": lambda t: staging.unique_customers(t.market("mk_customers")),
        "stg_first_order": lambda t: staging.first_order(*sources(t, "orders", "customers")),
        "stg_order_total": lambda t: staging.order_totals(*sources(t, "orders", "payments")),
        "stg_primary_payment": lambda t: staging.primary_payment(
            *sources(t, "orders", "payments")
        ),
        "stg_status": lambda t: staging.order_status(t.market("mk_orders")),
        "stg_orders": lambda t: staging.stage_orders(
            *sources(t, "orders", "payments", "customers"), P.SHIFT_ANCHOR
        ),
        "stg_order_items": lambda t: staging.stage_order_items(t.market("mk_items")),
        "stg_loyalty_exact": lambda t: staging.loyalty_by_payments(
            *sources(t, "orders", "payments", "customers")
        ),
        "stg_product_name": lambda t: staging.stage_products(
            t.market("mk_products"), t.translations()
        ),
        "stg_products": lambda t: staging.stage_products(
            t.market("mk_products"), t.translations(), staging.stage_order_items(t.market("mk_items"))
        ),
        "stg_users": lambda t: staging.stage_users(
            *sources(t, "customers", "orders", "payments"), P.SHIFT_ANCHOR
        ),
        "stg_tickets": lambda t: staging.stage_tickets(
            *sources(t, "reviews", "orders", "customers"), P.SHIFT_ANCHOR
        ),
        "stg_shift_dates": lambda t: staging.shifted_dates(t.market("mk_orders"), P.SHIFT_ANCHOR),
        "pseudonymise": lambda t: staging.pseudonymise(people(t)),
        "stg_ticket_status": lambda t: staging.ticket_status(t.market("mk_reviews")),
        "stg_rating": lambda t: staging.ticket_rating(t.market("mk_reviews")),
        "ticket_contact": lambda t: staging.ticket_contact(
            *sources(t, "reviews", "orders", "customers")
        ),
    }


def registered() -> dict[str, Query]:
    return {**_tables(), **_serving(), **_feeds(), **_quality(), **_staging()}


@lru_cache(maxsize=4)
def _star(spark: SparkSession, directory: str) -> BenchStar:
    """One set of lazy tables per session and directory; it holds plans, no data."""
    return BenchStar(spark, directory)


def raw_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The six raw tables a transform run starts from."""
    names = ("users", "products", "orders", "order_items", "events", "tickets")
    return {name: _star(spark, directory).raw(f"raw_{name}") for name in names}


def bound_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, query=query: query(_star(spark, sf_dir)))
        for name, query in registered().items()
    }
