from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.periods import in_month
from patronlake.plans import jobs, serving
from patronlake.sources import tables
from patronlake.sources.bench_tables import BenchStar

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark, request):
    name = "wh_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    yield tables.Warehouse(spark, name)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def products(spark, *rows):
    return spark.createDataFrame(
        [(p, f"name {p}", None, Decimal(c)) for p, c in rows], S.DIM_PRODUCTS.schema
    )


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_load_replaces_and_keeps_one_version_back(spark, warehouse):
    for n in range(1, 5):
        result = warehouse.load(products(spark, (f"p{n}", "1"), (f"q{n}", "2")), S.DIM_PRODUCTS)
        assert (result.rows, result.version, result.skipped) == (2, n, False)
        assert ids(warehouse.dim_products) == [f"p{n}", f"q{n}"]
    assert warehouse.versions("dim_products") == [3, 4]
    assert warehouse.current_version("dim_products") == 4


def test_crash_before_the_switch_leaves_the_old_table(spark, warehouse, monkeypatch):
    warehouse.load(products(spark, ("old", "1")), S.DIM_PRODUCTS)

    def die(self, table, version):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(tables.Warehouse, "publish", die)
        with pytest.raises(RuntimeError):
            warehouse.load(products(spark, ("half", "1")), S.DIM_PRODUCTS)
    assert warehouse.versions("dim_products") == [1, 2]
    assert ids(warehouse.dim_products) == ["old"]
    warehouse.load(products(spark, ("new", "1")), S.DIM_PRODUCTS)
    assert ids(warehouse.dim_products) == ["new"]
    assert warehouse.versions("dim_products") == [1, 2]


def test_empty_snapshot_keeps_the_old_table(spark, warehouse):
    warehouse.load(products(spark, ("a", "1")), S.DIM_PRODUCTS)
    result = warehouse.load(products(spark).limit(0), S.DIM_PRODUCTS)
    assert result.skipped and ids(warehouse.dim_products) == ["a"]
    assert warehouse.versions("dim_products") == [1]


def test_nulls_in_required_columns_stop_the_load(spark, warehouse):
    warehouse.load(products(spark, ("a", "1")), S.DIM_PRODUCTS)
    bad = products(spark, ("b", "1"), ("c", "1")).withColumn(
        "product_name", F.when(F.col("product_id") == "b", "x")
    )
    with pytest.raises(tables.NullViolation, match="product_name': 1"):
        warehouse.load(bad, S.DIM_PRODUCTS)
    assert ids(warehouse.dim_products) == ["a"] and warehouse.versions("dim_products") == [1]


def wide_rows(spark, *rows):
    schema = S.CUSTOMER_360.schema
    stamp = dt.datetime(2024, 1, 1, 1, 2, 3, 456789)
    return spark.createDataFrame(
        [(u, "n", "c", "s", tier, Decimal(1), 1, 0, 0, stamp, None) for u, tier in rows], schema
    )


def test_keyed_load_merges_and_is_idempotent(spark, warehouse):
    warehouse.load(wide_rows(spark, ("a", "Gold"), ("b", "Gold"), ("b", "Gold")), S.CUSTOMER_360)
    assert warehouse.customer_360.count() == 2
    for _ in range(2):
        warehouse.load(wide_rows(spark, ("b", "Silver"), ("c", None)), S.CUSTOMER_360)
        found = {r.user_id: r.loyalty_tier for r in warehouse.customer_360.collect()}
        assert found == {"a": "Gold", "b": "Silver", "c": None}
    assert warehouse.load(wide_rows(spark).limit(0), S.CUSTOMER_360).skipped
    assert warehouse.customer_360.count() == 3
    # The warehouse column holds whole seconds.
    assert warehouse.customer_360.first().last_active_date == dt.datetime(2024, 1, 1, 1, 2, 3)


def test_newest_row_per_key(spark):
    batches = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, load_seq int, v string"
    )
    found = {r.k: r.v for r in tables.newest_by_key(batches, "k").collect()}
    assert found == {"a": "new", "b": "only"}


def test_month_partitions_prune_and_files_are_sorted(spark, warehouse):
    star = BenchStar(spark, SMALL)
    known = star.fact_orders.filter("order_status IS NOT NULL")
    warehouse.load(known, S.FACT_ORDERS)
    orders = warehouse.fact_orders
    assert orders.filter("yyyymm <> year(created_at) * 100 + month(created_at)").count() == 0
    assert orders.count() == known.count()

    month = in_month(orders, "created_at", "1997-05")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan and "199705" in plan
    expected = known.filter("created_at >= '1997-05-01' AND created_at < '1997-06-01'").count()
    assert month.count() == expected > 0

    files = orders.select(F.input_file_name().alias("f"), "created_at", "order_id")
    for path in {r.f for r in files.select("f").distinct().collect()}:
        rows = spark.read.parquet(path).select("created_at", "order_id").collect()
        assert rows == sorted(rows)


def test_a_month_of_many_rows_is_split(spark):
    one_month = spark.range(50_000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("2024-05-05 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = (
            tables.spread(one_month, S.FACT_ORDERS)
            .withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(parts) == 8 and max(r["count"] for r in parts) < 15_000


def test_rewriting_a_day_leaves_the_others(spark, tmp_path):
    def day_rows(*rows):
        return spark.createDataFrame(rows, "event_id string, ts string").withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")
        )

    path = f"{tmp_path}/days"
    tables.write_days(day_rows(("1", "2024-01-01 10:00:00"), ("2", "2024-01-02 10:00:00")), path, "ts", "event_id")
    for _ in range(2):
        tables.write_days(day_rows(("3", "2024-01-02 11:00:00")), path, "ts", "event_id")
        assert ids(spark.read.parquet(path).select("event_id")) == ["1", "3"]


def test_one_logical_day_can_be_run_again(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "2024-01-01 10:00:00", "view_item"), ("2", "2024-01-02 10:00:00", "add_to_cart"),
         ("3", "2024-01-02 11:00:00", "purchase"), ("4", "2024-01-03 00:00:00", "view_item")],
        "event_id string, timestamp string, event_type string",
    ).withColumns({
        "timestamp": F.col("timestamp").cast("timestamp_ntz"), "user_id": F.lit("u"),
        "session_id": F.lit("s"), "product_id": F.lit("p"), "device_os": F.lit("x"),
        "time_spent_seconds": F.lit(1),
    })
    path = f"{tmp_path}/log"
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 2)):
        jobs.reload_day(raw, path, day)
    assert ids(spark.read.parquet(path).select("event_id")) == ["1", "2"]
    assert {str(r.day) for r in spark.read.parquet(path).collect()} == {"2024-01-01", "2024-01-02"}


def test_zone_routing(spark, tmp_path):
    zones = tables.Zones(spark, str(tmp_path))
    assert zones.path("customer_360").endswith("/serving/customer_360")
    assert zones.path("fact_orders").endswith("/clean/fact_orders")
    assert zones.path("orders").endswith("/raw/orders")


def test_whole_run_from_raw_to_warehouse(spark, tmp_path, warehouse):
    star = BenchStar(spark, SMALL)
    zones = tables.Zones(spark, str(tmp_path))
    raw = {
        name: star.raw(f"raw_{name}")
        for name in ("users", "products", "orders", "order_items", "events", "tickets")
    }
    sources = ("users", "products", "orders", "order_items")
    counts = jobs.run_extract({name: raw[name] for name in sources}, zones)
    assert counts == {name: raw[name].count() for name in sources}
    jobs.run_transforms({**raw, **{name: zones.read(name) for name in sources}}, zones)
    results = jobs.run_load(zones, warehouse, on_null="quarantine")
    for r in results:
        assert r.rows + r.rejected == zones.read(r.table).count()
    rejected = {r.table: r.rejected for r in results if r.rejected}
    assert rejected == {"fact_orders": raw["orders"].filter("order_status = 'mystery'").count()}
    assert warehouse.rejects("fact_orders").count() == rejected["fact_orders"]
    assert [r.table for r in results] == list(S.TABLES)
    assert all(r.rows > 0 and r.version == 1 for r in results)
    known = zones.fact_orders.filter("order_status IS NOT NULL")
    whole = SimpleNamespace(**{name: zones.read(name) for name in S.TABLES} | {"fact_orders": known})
    for query in (serving.revenue_by, serving.top_products, serving.customer_360_page):
        # The warehouse holds whole seconds of the last activity.
        loaded, clean = (query(t).drop("last_active_date").collect() for t in (warehouse, whole))
        assert loaded == clean
    assert (Path(tmp_path) / "serving" / "customer_360").exists()


def test_unknown_status_stops_the_order_load(spark, warehouse):
    with pytest.raises(tables.NullViolation, match="order_status"):
        warehouse.load(BenchStar(spark, SMALL).fact_orders, S.FACT_ORDERS)


def test_day_reload_reads_the_days_of_arrival_only(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    for day in ("2023-12-01", "2024-01-01", "2024-01-09"):
        spark.range(3).selectExpr(
            "CAST(id AS STRING) AS event_id", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS timestamp",
            "'view_item' AS event_type", "'u' AS user_id", "'s' AS session_id", "'p' AS product_id",
            "'x' AS device_os", "1 AS time_spent_seconds", f"DATE '{day}' AS ingest_date",
        ).write.mode("append").partitionBy("ingest_date").parquet(feed)
    jobs.reload_day(spark.read.parquet(feed), f"{tmp_path}/log", dt.date(2024, 1, 1))
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3


def test_day_reload_keeps_events_that_arrive_much_later(spark, tmp_path):
    feed = f"{tmp_path}/feed"
    for event, arrived in (("0", "2024-01-01"), ("1", "2024-01-03"), ("2", "2024-01-06")):
        spark.range(1).selectExpr(
            f"'{event}' AS event_id", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS timestamp",
            "'view_item' AS event_type", "'u' AS user_id", "'s' AS session_id", "'p' AS product_id",
            "'x' AS device_os", "1 AS time_spent_seconds", f"DATE '{arrived}' AS ingest_date",
        ).write.mode("append").partitionBy("ingest_date").parquet(feed)
    jobs.reload_day(spark.read.parquet(feed), f"{tmp_path}/log", dt.date(2024, 1, 1))
    assert ids(spark.read.parquet(f"{tmp_path}/log").select("event_id")) == ["0", "1", "2"]
