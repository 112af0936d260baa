"""The whole runs: extract, transform, load, and the reload of one day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.operators.events import clean_events
from patronlake.operators.orders import clean_order_items, clean_orders
from patronlake.operators.products import clean_products
from patronlake.operators.tickets import clean_tickets
from patronlake.operators.users import clean_users
from patronlake.operators.wide import customer_360
from patronlake.sources.landing import land
from patronlake.sources.tables import LoadResult, Warehouse, Zones, write_days

T = TypeVar("T")


def _side_by_side(tasks: Iterable[Callable[[], T]], at_once: int = 8) -> list[T]:
    """Run independent Spark actions at the same time, so that the tail of one table's job does not
    leave the cluster idle. Results keep the order of the tasks; the first failure is raised once
    all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        futures = [pool.submit(task) for task in tasks]
        wait(futures)
    return [future.result() for future in futures]


def run_extract(sources: dict[str, DataFrame], zones: Zones) -> dict[str, int]:
    """Land the database tables in the raw zone and return their row counts.

    Later stages read the landed files, so the database is read once per table however many
    transforms use it.
    """
    counts = _side_by_side(
        [lambda name=name, df=df: land(df, zones.path(name)) for name, df in sources.items()]
    )
    return dict(zip(sources, counts))


def run_transforms(raw: dict[str, DataFrame], zones: Zones) -> None:
    """Raw tables → clean zone → wide table.

    ``raw`` holds users, products, orders, order_items, events and tickets. The six clean tables
    need only raw ones, so they are written side by side. The wide table then reads them back from
    Parquet, where it gets pruned columns and pushed filters.
    """
    clean = {
        "dim_users": lambda: clean_users(raw["users"], raw["orders"]),
        "dim_products": lambda: clean_products(raw["products"], raw["order_items"]),
        "fact_order_items": lambda: clean_order_items(raw["order_items"]),
        "fact_orders": lambda: clean_orders(raw["orders"]),
        "fact_events_log": lambda: clean_events(raw["events"]),
        "fact_cs_tickets": lambda: clean_tickets(raw["tickets"]),
    }
    _side_by_side(
        [lambda name=name, build=build: zones.write(build(), name) for name, build in clean.items()]
    )
    wide = customer_360(
        zones.dim_users, zones.fact_orders, zones.fact_events_log, zones.fact_cs_tickets
    )
    zones.write(wide, "customer_360")


def reload_day(raw_events: DataFrame, path: str, day: dt.date, late_days: int = 2) -> None:
    """Clean one logical day of events and rewrite just that day under ``path``.

    Running it again gives the same files; other days are not touched. A day without events is
    left as it is. A feed with ``ingest_date`` partitions is read from the day before on, as events
    arrive on their day or later. Of those that arrive more than ``late_days`` after it, replays of
    events that had arrived by then are left out; all others are kept, however late.
    """
    first, following = (
        F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")
        for d in (day, day + dt.timedelta(days=1))
    )
    stamp = F.col("timestamp")

    def of_day(raw: DataFrame) -> DataFrame:
        return clean_events(raw).filter((stamp >= first) & (stamp < following))

    if "ingest_date" in raw_events.columns:
        arrived = F.col("ingest_date").cast("date")
        before, in_time = (F.lit(day + dt.timedelta(days=n)) for n in (-1, late_days))
        events = of_day(raw_events.filter(arrived.between(before, in_time)))
        late = of_day(raw_events.filter(arrived > in_time))
        known = events.select("event_id").distinct()
        events = events.unionByName(late.join(known, "event_id", "left_anti"))
    else:
        events = of_day(raw_events)
    write_days(events, path, "timestamp", "event_id")


def run_load(zones: Zones, warehouse: Warehouse, on_null: str = "fail") -> list[LoadResult]:
    """All seven tables, each on its own: readers see every table switch once it is complete.

    ``on_null="quarantine"`` sets rows with NULLs in required columns apart instead of stopping.
    """
    return _side_by_side([
        lambda spec=spec: warehouse.load(zones.read(spec.name), spec, on_null)
        for spec in S.TABLES.values()
    ])
