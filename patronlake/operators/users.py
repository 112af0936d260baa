"""dim_users: validate given tiers, or derive tier and sign-up date from the orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.stamps import parse_stamp
from patronlake.functions.vocab import keep_if_in
from patronlake.operators.cleaning import CleanPlan, clean_rows
from patronlake.operators.ranks import disc_rank, exact_order_statistics

# The fraction of spenders below each tier, and the words for a completed raw order.
TIER_FRACTIONS = {"silver": 0.65, "gold": 0.85, "platinum": 0.95}
COMPLETED_WORDS = ["Completed", "delivered"]
_PROFILE = ["user_id", "full_name", "email", "phone_number", "customer_city", "customer_state"]


def users_plan(raw: DataFrame) -> CleanPlan:
    columns = {name: F.col(name) for name in _PROFILE}
    columns["loyalty_tier"] = keep_if_in(F.col("loyalty_tier"), S.LOYALTY_TIERS)
    columns["created_at"] = parse_stamp(F.col("created_at"), raw.schema["created_at"].dataType)
    return CleanPlan(
        S.DIM_USERS.name,
        "user_id",
        columns,
        parsed={"created_at": "created_at"},
        remapped={"loyalty_tier": "loyalty_tier"},
    )


def user_order_history(raw_orders: DataFrame) -> DataFrame:
    """Per user: first order, completed orders, completed spend. One pass over the raw orders.

    Guest orders form one group under the NULL user; partial aggregation folds it before the
    shuffle, however large it is.
    """
    created = parse_stamp(F.col("created_at"), raw_orders.schema["created_at"].dataType)
    done = F.col("order_status").isin(*COMPLETED_WORDS)
    amount = F.col("total_amount").try_cast("decimal(18,2)")
    return raw_orders.groupBy("user_id").agg(
        F.min(created).alias("first_order_at"),
        F.count_if(done).alias("completed_orders"),
        F.sum(F.when(done, amount)).alias("total_spend"),
    )


def user_spend(raw_orders: DataFrame, exclude_guests: bool = False) -> DataFrame:
    spend = (
        user_order_history(raw_orders)
        .filter(F.col("completed_orders") > 0)
        .select("user_id", "total_spend")
    )
    return spend.filter(F.col("user_id").isNotNull()) if exclude_guests else spend


def loyalty_thresholds(spend: DataFrame, relative_error: float | None = None) -> DataFrame:
    """One row: the spend from which silver, gold and platinum start; NULL when nobody spent.

    Exact by default. A ``relative_error`` (0.01, say) takes them from a mergeable sketch instead:
    one aggregation, ranks off by at most that share of the spenders.
    """
    if relative_error is None:
        wanted = {name: disc_rank(p) for name, p in TIER_FRACTIONS.items()}
        return exact_order_statistics(spend, "total_spend", wanted)
    sketch = spend.agg(
        F.percentile_approx(
            "total_spend", list(TIER_FRACTIONS.values()), max(1, round(1 / relative_error))
        ).alias("q")
    )
    return sketch.select(*[
        F.get("q", F.lit(i)).alias(name) for i, name in enumerate(TIER_FRACTIONS)
    ])


def thresholds_in_range(spend: DataFrame, thresholds: DataFrame, error: float) -> DataFrame:
    """One row: whether each threshold's rank among the spenders is within ``error`` of its fraction."""
    t = thresholds.select(F.struct(*TIER_FRACTIONS).alias("t"))
    rows = spend.withColumn("t", t.scalar())
    below, upto = (
        {n: F.count_if(test(F.col("total_spend"), F.col(f"t.{n}"))) / F.count("total_spend") for n in TIER_FRACTIONS}
        for test in (lambda a, b: a < b, lambda a, b: a <= b)
    )
    return rows.agg(*[
        ((below[n] - error <= p) & (upto[n] + error >= p)).alias(n) for n, p in TIER_FRACTIONS.items()
    ])


def tier_of(spend: Column, thresholds: Column) -> Column:
    return (
        F.when(spend >= thresholds["platinum"], "Platinum")
        .when(spend >= thresholds["gold"], "Gold")
        .when(spend >= thresholds["silver"], "Silver")
        .otherwise("Bronze")
    )


def _derive_users(
    raw: DataFrame, raw_orders: DataFrame, exclude_guests: bool, relative_error: float | None
) -> DataFrame:
    thresholds = loyalty_thresholds(user_spend(raw_orders, exclude_guests), relative_error)
    one_row = thresholds.select(F.struct(*TIER_FRACTIONS).alias("t"))
    history = (
        user_order_history(raw_orders)
        .withColumn("t", one_row.scalar())
        .select(
            "user_id",
            "first_order_at",
            F.when(F.col("completed_orders") > 0, tier_of(F.col("total_spend"), F.col("t")))
            .alias("derived_tier"),
        )
    )
    created = F.col("first_order_at")
    if "created_at" in raw.columns:
        given = parse_stamp(F.col("created_at"), raw.schema["created_at"].dataType)
        created = F.coalesce(created, given)
    return raw.join(history, "user_id", "left").select(
        *_PROFILE, F.col("derived_tier").alias("loyalty_tier"), created.alias("created_at")
    )


def clean_users(
    raw: DataFrame,
    raw_orders: DataFrame | None = None,
    exclude_guests: bool = False,
    relative_error: float | None = None,
) -> DataFrame:
    """Users that bring tier and sign-up date are validated; otherwise both come from the orders."""
    if {"loyalty_tier", "created_at"} <= set(raw.columns):
        return clean_rows(raw, users_plan(raw))
    if raw_orders is None:
        raise ValueError("users without loyalty_tier need the orders to derive it from")
    return _derive_users(raw, raw_orders, exclude_guests, relative_error)
