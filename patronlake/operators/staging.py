"""Staging: marketplace exports → the raw tables of the source systems.

Inputs are text columns as exported. Unreadable numbers are left out of sums, unknown words take
the staging defaults, and lookups that miss keep their own key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions import pseudonyms
from patronlake.functions.stamps import NTZ, shift_text
from patronlake.functions.text import email_fault, title_case
from patronlake.functions.vocab import remap_or
from patronlake.operators.products import clean_products
from patronlake.operators.ranks import disc_rank, exact_order_statistics, index_rank
from patronlake.operators.skew import spread_left_join
from patronlake.operators.tickets import category_of_rating
from patronlake.operators.users import TIER_FRACTIONS, tier_of

# What staging assumes where the source says nothing usable.
DEFAULT_STATUS = "Pending"
DEFAULT_PAYMENT = "Credit Card"
DEFAULT_RATING = 3
FIRST_PAYMENT = "1"

_MONEY = "decimal(18,2)"


def unique_customers(customers: DataFrame) -> DataFrame:
    """One row per person, the first in file order.

    ``row_number() = 1`` is cut down to one row per person before the shuffle already, so a person
    with very many accounts stays cheap.
    """
    first = W.partitionBy("customer_unique_id").orderBy("file_row")
    return (
        customers.withColumn("nth", F.row_number().over(first))
        .filter("nth = 1")
        .select("customer_unique_id", "customer_id", "customer_city", "customer_state")
    )


def account_owners(customers: DataFrame) -> DataFrame:
    """customer_id → customer_unique_id; the last row of the file wins for a repeated account."""
    return customers.groupBy("customer_id").agg(
        F.max_by("customer_unique_id", "file_row").alias("owner")
    )


def owned_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the person behind the account; an unknown account stands for itself."""
    return (
        spread_left_join(orders, account_owners(customers), "customer_id", salt_by="order_id")
        .withColumn("user_id", F.coalesce("owner", "customer_id"))
        .drop("owner")
    )


def _purchase_stamp() -> Column:
    return F.regexp_replace(F.trim("order_purchase_timestamp"), "Z$", "").try_cast(NTZ)


def first_order(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """First purchase per known person; folded per account before the accounts meet their owners."""
    per_account = orders.groupBy("customer_id").agg(F.min(_purchase_stamp()).alias("first_at"))
    return (
        per_account.join(account_owners(customers), "customer_id")
        .groupBy(F.col("owner").alias("user_id"))
        .agg(F.min("first_at").alias("first_order_at"))
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """Per order: sum of readable payments, and the method of payment number 1. One pass.

    Of several first payments the last one of the file stands. The method travels as its position in
    the vocabulary: a number keeps the aggregation in the hash path, which text would leave.
    """
    words = F.array(*[F.lit(w) for w in S.PAYMENT_METHODS])
    method = remap_or(F.col("payment_type"), S.PAYMENT_ALIASES, DEFAULT_PAYMENT)
    first = F.col("payment_sequential") == FIRST_PAYMENT
    position = F.array_position(words, method).cast("int")
    return (
        payments.groupBy("order_id")
        .agg(
            F.sum(F.col("payment_value").try_cast(_MONEY)).alias("paid"),
            F.max_by(position, F.when(first, F.col("file_row"))).alias("position"),
        )
        .select(
            "order_id",
            F.col("paid").cast(_MONEY).alias("paid"),
            F.try_element_at(words, F.col("position")).alias("method"),
        )
    )


def order_totals(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Order total = its payments; an order nobody paid for has none."""
    return orders.select("order_id").join(order_payments(payments), "order_id", "left").select(
        "order_id", F.col("paid").alias("total_amount")
    )


def primary_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orders.select("order_id").join(order_payments(payments), "order_id", "left").select(
        "order_id", F.coalesce("method", F.lit(DEFAULT_PAYMENT)).alias("payment_method")
    )


def _status() -> Column:
    return remap_or(F.col("order_status"), S.STATUS_ALIASES, DEFAULT_STATUS)


def order_status(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", _status().alias("order_status"))


def stage_orders(
    orders: DataFrame, payments: DataFrame, customers: DataFrame, anchor: dt.datetime
) -> DataFrame:
    """The orders table as the source system holds it."""
    return (
        owned_orders(orders, customers)
        .join(order_payments(payments), "order_id", "left")
        .select(
            "order_id",
            "user_id",
            F.col("paid").alias("total_amount"),
            _status().alias("order_status"),
            F.coalesce("method", F.lit(DEFAULT_PAYMENT)).alias("payment_method"),
            shift_text(F.col("order_purchase_timestamp"), anchor).alias("created_at"),
        )
    )


def shifted_dates(orders: DataFrame, anchor: dt.datetime) -> DataFrame:
    return orders.select(
        "order_id", shift_text(F.col("order_purchase_timestamp"), anchor).alias("created_at")
    )


def stage_order_items(items: DataFrame) -> DataFrame:
    """Marketplace items as keyed items: quantity 1, unreadable price 0."""
    price = F.coalesce(F.col("price").try_cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)"))
    return items.select(
        F.concat_ws("_", "order_id", "order_item_id").alias("item_id"),
        "order_id",
        "product_id",
        F.lit(1).cast("short").alias("quantity"),
        price.alias("unit_price"),
    )


def stage_products(
    products: DataFrame, translations: DataFrame, items: DataFrame | None = None
) -> DataFrame:
    """Readable category and product name; a category without translation keeps its own word.

    Of several translations of a category the last one of the file stands. With ``items`` the cost
    price comes too: unsold products cost 0. Products that share a category, or have none, are spread.
    """
    usable = (
        translations.filter(F.trim("product_category_name_english") != "")
        .groupBy("product_category_name")
        .agg(F.max_by("product_category_name_english", "file_row").alias("english"))
    )
    word = F.nullif(F.coalesce("english", "product_category_name"), F.lit(""))
    category = title_case(F.regexp_replace(word, "_", " "))
    number = (F.conv(F.left(F.md5("product_id"), F.lit(6)), 16, 10).cast("bigint") % 10_000)
    name = F.concat(
        F.coalesce(F.concat(category, F.lit(" Item #")), F.lit("Product #")), number.cast("string")
    )
    named = spread_left_join(
        products, usable, "product_category_name", salt_by="product_id"
    ).select("product_id", name.alias("product_name"), category.alias("category"))
    return named if items is None else clean_products(named, items)


def payments_per_user(
    orders: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    """Everything a known person ever paid.

    Payments are folded per order, orders per account, and accounts per person, each before the
    next join, so every join is one row to one row.
    """
    paid = order_payments(payments).filter("paid IS NOT NULL").select("order_id", "paid")
    per_account = (
        orders.select("order_id", "customer_id")
        .join(paid, "order_id")
        .groupBy("customer_id")
        .agg(F.sum("paid").alias("spend"))
    )
    return (
        per_account.join(account_owners(customers), "customer_id")
        .groupBy(F.col("owner").alias("user_id"))
        .agg(F.sum("spend").alias("total_spend"))
    )


def loyalty_by_payments(
    orders: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    """Tier of every person by all payments. A tier starts at the spend found at index
    int(n · fraction) of the sorted spends; without positive spend there is no tier."""
    spend = payments_per_user(orders, payments, customers)
    thresholds = exact_order_statistics(
        spend, "total_spend", {name: index_rank(p) for name, p in TIER_FRACTIONS.items()}
    ).select(F.struct(*TIER_FRACTIONS).alias("t"))
    tiers = spend.withColumn("t", thresholds.scalar()).select(
        "user_id",
        F.col("total_spend").cast("decimal(38,2)").alias("total_spend"),
        F.when(F.col("total_spend") > 0, tier_of(F.col("total_spend"), F.col("t")))
        .alias("loyalty_tier"),
    )
    people = customers.select(F.col("customer_unique_id").alias("user_id")).distinct()
    return people.join(tiers, "user_id", "left")


def pseudonymise(people: DataFrame, key: str = "user_id") -> DataFrame:
    entity = F.col(key)
    name = pseudonyms.full_name(entity)
    return people.select(
        key,
        name.alias("full_name"),
        pseudonyms.email(entity, name).alias("email"),
        pseudonyms.phone(entity).alias("phone_number"),
    )


def ticket_status(reviews: DataFrame) -> DataFrame:
    answered = F.trim("review_answer_timestamp") != ""
    return reviews.select(
        F.col("review_id").alias("ticket_id"),
        F.when(answered, "Resolved").otherwise("Open").alias("status"),
    )


def ticket_rating(reviews: DataFrame) -> DataFrame:
    """Score held within 1 to 5, unreadable ones taken as 3, and the issue type it implies."""
    score = F.coalesce(F.col("review_score").try_cast("int"), F.lit(DEFAULT_RATING))
    rating = F.greatest(F.lit(1), F.least(F.lit(5), score))
    return reviews.select(
        F.col("review_id").alias("ticket_id"),
        rating.alias("rating"),
        category_of_rating(rating).alias("issue_type"),
    )


def ticket_contact(reviews: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Ticket → order → person → e-mail; a ticket without a known order has no contact."""
    owners = owned_orders(orders, customers).select("order_id", "user_id")
    return spread_left_join(reviews, owners, "order_id", salt_by="review_id").select(
        F.col("review_id").alias("ticket_id"),
        "user_id",
        pseudonyms.email(F.col("user_id")).alias("email"),
    )


def stage_users(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, anchor: dt.datetime
) -> DataFrame:
    """The users table as the source system holds it.

    Signed up with the first order; a person without any on a day of early 2017 to mid 2018 that
    follows from the id. The parts are one row per person each, so joins are one row to one row.
    """
    person = F.col("customer_unique_id")
    eight = F.conv(F.left(F.md5(person), F.lit(8)), 16, 10).cast("bigint")
    day = F.date_add(F.lit("2017-01-01").cast("date"), (eight % 540).cast("int")).cast(NTZ)
    joined = (
        unique_customers(customers)
        .join(first_order(orders, customers), person == F.col("user_id"), "left").drop("user_id")
        .join(loyalty_by_payments(orders, payments, customers), person == F.col("user_id"), "left")
    )
    signed_up = F.left(F.coalesce("first_order_at", day).cast("string"), F.lit(19))
    name = pseudonyms.full_name(person)
    return joined.select(
        person.alias("user_id"),
        name.alias("full_name"),
        pseudonyms.email(person, name).alias("email"),
        pseudonyms.phone(person).alias("phone_number"),
        "customer_city",
        "customer_state",
        "loyalty_tier",
        shift_text(signed_up, anchor).alias("created_at"),
    )


def stage_tickets(
    reviews: DataFrame, orders: DataFrame, customers: DataFrame, anchor: dt.datetime
) -> DataFrame:
    """Support tickets as the ticket tool exports them, reported when the review was created or, for
    want of that, answered."""
    score = F.coalesce(F.col("review_score").try_cast("int"), F.lit(DEFAULT_RATING))
    rating = F.greatest(F.lit(1), F.least(F.lit(5), score))
    given = [F.nullif(F.trim(c), F.lit("")) for c in ("review_creation_date", "review_answer_timestamp")]
    answered = F.trim("review_answer_timestamp") != ""
    owners = owned_orders(orders, customers).select("order_id", "user_id")
    return spread_left_join(reviews, owners, "order_id", salt_by="review_id").select(
        F.col("review_id").alias("Ticket_ID"),
        F.col("order_id").alias("Order_ID"),
        pseudonyms.email(F.col("user_id")).alias("Customer_Email"),
        category_of_rating(rating).alias("Issue_Type"),
        F.when(answered, "Resolved").otherwise("Open").alias("Status"),
        rating.alias("Customer_Rating"),
        shift_text(F.coalesce(*given), anchor).alias("Reported_Date"),
    )


def email_quality(tickets: DataFrame, column: str = "Customer_Email") -> DataFrame:
    fault = email_fault(F.col(column)).alias("email_class")
    return tickets.groupBy(fault).agg(F.count("*").alias("cnt"))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    trimmed = F.trim(F.col(column)).alias("id")
    return df.select(trimmed).filter(F.col("id") != "").distinct()


def order_value_profile(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Mean, median, P75 and P95 of the order value, and mean items per order. All exact."""
    quantiles = exact_order_statistics(
        orders.select("total_amount"),
        "total_amount",
        {
            "median_value": disc_rank(0.5),
            "p75_value": disc_rank(0.75),
            "p95_value": disc_rank(0.95),
        },
    )
    mean = orders.agg(
        F.round(F.sum("total_amount") / F.count("total_amount"), 2).cast(_MONEY).alias("m")
    )
    per_order = items.groupBy("order_id").agg(F.count("*").alias("n")).agg(
        F.try_divide(F.sum("n").cast("double"), F.count("*")).alias("r")
    )
    return quantiles.withColumns({
        "mean_value": mean.scalar(), "items_per_order": per_order.scalar(),
    })
