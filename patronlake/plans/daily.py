"""One date through the whole star: facts by day, and customer_360 kept up by touched users.

State. `facts`: orders, items, events and tickets in a folder for each day. `activity`: what each day, and
each order with complaints, adds to a user's measures, by user. `links`: owners and complaints of each
order, by order, as a ticket may come days before or after its order. `wide`: customer_360, by user.

A refresh takes the raw rows of a date. The date's rows take the place of those stored for it, so a late
or corrected delivery is the same call again, and the same call again changes nothing:

- users of the old and of the new rows get the date's part anew;
- orders that came, went or changed hands, and orders that complaints came to or went from, get their
  part anew, for their old and new owners;
- rows of customer_360 are made again for these users from their parts, and for users whose profile
  differs from what customer_360 has. Sums and counts add up over parts, and a latest date that went
  away is found in the parts that are left: no other user's facts are read.

Facts are written last. A refresh that dies is simply run again: until the facts are in place it finds
the same old rows and so the same users and orders, and each table switches in one step.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake import schemas as S
from patronlake.operators.events import clean_events
from patronlake.operators.orders import clean_order_items, clean_orders
from patronlake.operators.tickets import clean_tickets
from patronlake.operators.wide import wide_rows
from patronlake.sources.keyed import BUCKETS, GONE, KeyedTable, MergeResult

_LONG, _STR, _NTZ = T.LongType(), T.StringType(), T.TimestampNTZType()
_MEASURES = {
    "spend": T.DecimalType(28, 2), "orders": _LONG, "carts": _LONG, "complaints": _LONG,
    "ordered_at": _NTZ, "seen_at": _NTZ,
}
ACTIVITY = T.StructType([
    T.StructField("user_id", _STR, False), T.StructField("part", _STR, False),
    *[T.StructField(name, kind, True) for name, kind in _MEASURES.items()],
])
LINKS = T.StructType([
    T.StructField("order_id", _STR, False), T.StructField("part", _STR, False),
    T.StructField("user_id", _STR, True), T.StructField("complaints", _LONG, True),
])
_STAMPS = {"fact_orders": "created_at", "fact_events_log": "timestamp", "fact_cs_tickets": "reported_at"}
_PROFILE = ("full_name", "customer_city", "customer_state", "loyalty_tier")
_NO_DAY = "none"


def _day_of(stamp: str) -> Column:
    return F.coalesce(F.to_date(stamp).cast("string"), F.lit(_NO_DAY))


def day_parts(orders: DataFrame, events: DataFrame) -> DataFrame:
    """(user_id, part, measures): what the rows of each day add to each user. One aggregation."""
    bought = orders.filter(F.col("order_status") == S.COMPLETED).select(
        "user_id", _day_of("created_at").alias("day"), "total_amount",
        F.col("order_id").isNotNull().cast("long").alias("one_order"), F.col("created_at").alias("bought_at"),
    )
    left = F.col("event_id").isNotNull() & (F.col("event_type") == S.ABANDONED)
    seen = events.select(
        "user_id", _day_of("timestamp").alias("day"), left.cast("long").alias("one_cart"), F.col("timestamp").alias("at"),
    )
    return (
        bought.unionByName(seen, allowMissingColumns=True).filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.concat(F.lit("day:"), "day").alias("part"))
        .agg(
            F.sum("total_amount").cast("decimal(28,2)").alias("spend"), F.sum("one_order").alias("orders"),
            F.sum("one_cart").alias("carts"), F.max("bought_at").alias("ordered_at"), F.max("at").alias("seen_at"),
        )
    )


def link_parts(orders: DataFrame, tickets: DataFrame) -> DataFrame:
    """(order_id, part, user_id, complaints): the owner of each order and its complaints by day."""
    owners = orders.filter(F.col("order_id").isNotNull()).select(
        "order_id", F.concat(F.lit("order:"), _day_of("created_at")).alias("part"), "user_id",
    ).groupBy("order_id", "part").agg(F.max("user_id").alias("user_id"))
    complaints = (
        tickets.filter((F.col("issue_category") == S.COMPLAINT) & F.col("order_id").isNotNull())
        .groupBy("order_id", F.concat(F.lit("ticket:"), _day_of("reported_at")).alias("part"))
        .agg(F.count("ticket_id").alias("complaints"))
    )
    return owners.unionByName(complaints, allowMissingColumns=True)


def complaint_parts(links: DataFrame) -> DataFrame:
    """(user_id, part, complaints): what the complaints about an order add to its owner.

    An order that stands under several dates has an owner for each.
    """
    per_order = links.groupBy("order_id").agg(
        F.sum("complaints").alias("complaints"), F.collect_list("user_id").alias("owners")
    )
    return (
        per_order.filter(F.col("complaints") > 0).select("order_id", F.explode("owners").alias("user_id"), "complaints")
        .groupBy("user_id", F.concat(F.lit("order:"), "order_id").alias("part"))
        .agg(F.sum("complaints").alias("complaints"))
    )


def measures(activity: DataFrame) -> DataFrame:
    """Parts added up: the columns of ``wide.user_activity``."""
    fold = {name: F.max if isinstance(kind, T.TimestampNTZType) else F.sum for name, kind in _MEASURES.items()}
    return activity.groupBy("user_id").agg(*[f(name).alias(name) for name, f in fold.items()])


def _without(parts: DataFrame, stay: DataFrame, keys: list[str]) -> DataFrame:
    """Marks that delete the parts that are not among those that stay."""
    return parts.select(*keys).distinct().join(stay.select(*keys), keys, "left_anti").withColumn(GONE, F.lit(True))


def _stacked(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _piece(pieces: dict[int, list[str]], columns: list[str]) -> Column:
    """The piece of its day (column `place`) that a row goes to, by all of its columns."""
    found = F.lit(0).cast("long")
    for n, days in sorted(pieces.items()):
        found = F.when(F.col("place").isin(days), F.pmod(F.xxhash64(*columns), F.lit(n))).otherwise(found)
    return found


@dataclass(frozen=True)
class RefreshResult:
    activity: MergeResult
    wide: MergeResult
    links: MergeResult


class DailyStar:
    """The state under a folder (facts) and a database (tables by key)."""

    def __init__(self, spark: SparkSession, folder: str, database: str, buckets: int = BUCKETS):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.activity = KeyedTable(spark, database, "activity", ACTIVITY, "user_id", ("user_id", "part"), buckets)
        self.links = KeyedTable(spark, database, "links", LINKS, "order_id", ("order_id", "part"), buckets)
        self.wide = KeyedTable(spark, database, "customer_360", S.CUSTOMER_360.schema, "user_id", (), buckets)

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def stored(self, table: str, day: dt.date) -> DataFrame:
        """The rows that a fact table has for a date; just that folder is read."""
        schema = S.TABLES[table].schema
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/day={day.isoformat()}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path.toString())

    def facts(self, table: str) -> DataFrame:
        spec = S.TABLES[table]
        return self.spark.read.schema(spec.schema).parquet(self.path(table)).select(*spec.columns)

    def _staged(self, rows: DataFrame, table: str) -> DataFrame:
        """Clean rows, written once: what follows reads them more than once."""
        path = f"{self.folder}/_incoming/{table}"
        rows = rows.select(*S.TABLES[table].columns) if table in S.TABLES else rows
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def load(self, users: DataFrame, orders: DataFrame, items: DataFrame, events: DataFrame, tickets: DataFrame) -> None:
        """The first load, from clean tables."""
        links = link_parts(orders, tickets)
        self.links.merge(links)
        self.activity.merge(_stacked(day_parts(orders, events), complaint_parts(self.links.read())))
        self.wide.merge(wide_rows(users, measures(self.activity.read())))
        dated = items.join(orders.select("order_id", "created_at"), "order_id", "left")
        sized = {table: self._pieces(rows, _STAMPS[table]) for table, rows in zip(_STAMPS, (orders, events, tickets))}
        rows = {"fact_orders": orders, "fact_events_log": events, "fact_cs_tickets": tickets, "fact_order_items": dated}
        for table, clean in rows.items():
            stamp, columns = _STAMPS.get(table, "created_at"), S.TABLES[table].columns
            by_day = clean.select(*columns, F.to_date(stamp).alias("day"), _day_of(stamp).alias("place"))
            by_day = by_day.repartition("place", _piece(sized.get(table, sized["fact_orders"]), columns)).drop("place")
            by_day.write.mode("overwrite").partitionBy("day").parquet(self.path(table))

    def _pieces(self, rows: DataFrame, stamp: str) -> dict[int, list[str]]:
        """Days that hold more rows than a partition should, by the number of pieces (a power of 2) they go to.

        A pass over the stamps alone. Ranges would need a sample, for which Spark evaluates all rows of the
        table twice; items take the days of their orders, so their join is done once.
        """
        counts = rows.groupBy(_day_of(stamp).alias("day")).count().collect()
        share = sum(r["count"] for r in counts) / int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found: dict[int, list[str]] = {}
        for r in counts:
            if r["count"] > share:
                found.setdefault(1 << (math.ceil(r["count"] / share) - 1).bit_length(), []).append(r["day"])
        return found

    def refresh(self, raw: dict[str, DataFrame], users: DataFrame, day: dt.date) -> RefreshResult:
        """Takes in a date's raw orders, order_items, events and tickets; `users` are all clean users.

        Rows of other dates in `raw` are left out; items are those of the date's orders.
        """
        first, following = (
            F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in (day, day + dt.timedelta(days=1))
        )
        clean = {
            "fact_orders": clean_orders(raw["orders"]), "fact_events_log": clean_events(raw["events"]),
            "fact_cs_tickets": clean_tickets(raw["tickets"]),
        }
        new = {
            table: self._staged(rows.filter((F.col(_STAMPS[table]) >= first) & (F.col(_STAMPS[table]) < following)), table)
            for table, rows in clean.items()
        }
        users = self._staged(users.select("user_id", *_PROFILE), "profiles")
        old = {table: self.stored(table, day) for table in new}
        link_keys, activity_keys = ["order_id", "part"], ["user_id", "part"]

        links = link_parts(new["fact_orders"], new["fact_cs_tickets"])
        links = _stacked(links, _without(link_parts(old["fact_orders"], old["fact_cs_tickets"]), links, link_keys))
        before = self._staged(self.links.rows_of(links), "links")
        gone = F.col(GONE).isNull() | ~F.col(GONE)
        after = _stacked(before.join(links.select(*link_keys), link_keys, "left_anti"), links.filter(gone).drop(GONE))
        told, was = complaint_parts(after), complaint_parts(before)

        parts = day_parts(new["fact_orders"], new["fact_events_log"])
        old_parts = day_parts(old["fact_orders"], old["fact_events_log"])
        activity = self.activity.merge(_stacked(
            parts, _without(old_parts, parts, activity_keys), told, _without(was, told, activity_keys)
        ))
        touched = self._staged(_stacked(
            *[x.select("user_id") for x in (parts, old_parts, told, was)], self._changed(users)
        ).distinct(), "touched")
        wide = self.wide.merge(wide_rows(
            users.join(touched, "user_id", "left_semi"), measures(self.activity.rows_of(touched))
        ))
        linked = self.links.merge(links)
        for table, rows in new.items():
            self._replace_day(rows, table, day)
        items = clean_order_items(raw["order_items"]).join(new["fact_orders"].select("order_id"), "order_id", "left_semi")
        self._replace_day(items, "fact_order_items", day)
        return RefreshResult(activity, wide, linked)

    def _changed(self, users: DataFrame) -> DataFrame:
        """Users whose profile is not the one that customer_360 has. No fact is read for it."""
        had = self.wide.read().select(F.col("user_id").alias("had"), F.struct(*_PROFILE).alias("profile"))
        same = (F.col("user_id") == F.col("had")) & F.col("profile").eqNullSafe(F.struct(*[users[c] for c in _PROFILE]))
        return users.join(had, same, "left_anti").select("user_id")

    def _replace_day(self, rows: DataFrame, table: str, day: dt.date) -> None:
        """The folder of the date holds these rows, or none if there are none. They are evaluated once."""
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path(table)}/day={day.isoformat()}")
