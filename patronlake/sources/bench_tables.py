"""The raw and clean tables over a directory of benchmark Parquet tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake.operators.events import clean_events
from patronlake.operators.orders import clean_order_items, clean_orders
from patronlake.operators.products import clean_products
from patronlake.operators.tickets import clean_tickets
from patronlake.operators.users import clean_users
from patronlake.operators.wide import customer_360
from patronlake.sources import shapes


class BenchStar:
    """Lazy tables: nothing is read before it is asked for, and nothing runs before an action."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """Opened once: each opening reads a footer for the schema."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._opened[name]

    def _customer_places(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return (
            self.source("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def shape(self, origin: str, expressions: dict[str, str]) -> DataFrame:
        base = self._customer_places() if origin == shapes.CUSTOMER_PLACES else self.source(origin)
        return base.selectExpr(*[
            f"{sql.replace('{NTZ}', 'TIMESTAMP_NTZ')} AS `{name}`" for name, sql in expressions.items()
        ])

    def raw(self, name: str) -> DataFrame:
        return self.shape(*shapes.RAW_SHAPES[name])

    def market(self, name: str) -> DataFrame:
        return self.shape(*shapes.MARKET_SHAPES[name])

    def translations(self) -> DataFrame:
        """Several rows to a category; some categories have no translation."""
        return self.shape("part", shapes.MARKET_TRANSLATIONS)

    @cached_property
    def raw_users(self) -> DataFrame:
        return self.raw("raw_users")

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.raw("raw_orders")

    @cached_property
    def raw_order_items(self) -> DataFrame:
        return self.raw("raw_order_items")

    @cached_property
    def raw_events(self) -> DataFrame:
        return self.raw("raw_events")

    @cached_property
    def raw_tickets(self) -> DataFrame:
        return self.raw("raw_tickets")

    @cached_property
    def dim_users(self) -> DataFrame:
        return clean_users(self.raw_users, self.raw_orders)

    @cached_property
    def dim_products(self) -> DataFrame:
        return clean_products(self.raw("raw_products"), self.raw_order_items)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return clean_orders(self.raw_orders)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return clean_order_items(self.raw_order_items)

    @cached_property
    def fact_events_log(self) -> DataFrame:
        return clean_events(self.raw_events)

    @cached_property
    def fact_cs_tickets(self) -> DataFrame:
        return clean_tickets(self.raw_tickets)

    @cached_property
    def customer_360(self) -> DataFrame:
        return customer_360(
            self.dim_users, self.fact_orders, self.fact_events_log, self.fact_cs_tickets
        )
