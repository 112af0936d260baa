"""dim_products: pass through, or derive the cost from what the product sold for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.operators.cleaning import CleanPlan, clean_rows
from patronlake.operators.orders import price_column


def cost_prices(items: DataFrame) -> DataFrame:
    """70 % of the average selling price per product, rounded half up to cents.

    Taken from exact decimal sums: 0.7 · avg = 7 · sum / (10 · count). A double average would
    round ties by accident.
    """
    price = F.col(price_column(items)).try_cast("decimal(12,2)")
    total = F.sum(price).cast("decimal(20,2)") * 7
    return items.groupBy("product_id").agg(
        F.round(total / (F.count(price) * 10), 2).cast("decimal(10,2)").alias("cost_price")
    )


def clean_products(raw: DataFrame, raw_items: DataFrame | None = None) -> DataFrame:
    """``raw_items`` is read only when the products carry no cost_price; unsold products cost 0."""
    if "cost_price" in raw.columns:
        return clean_rows(raw, products_plan())
    if raw_items is None:
        raise ValueError("products without cost_price need the order items to derive it from")
    no_cost = F.lit(0).cast("decimal(10,2)")
    return raw.join(cost_prices(raw_items), "product_id", "left").select(
        "product_id", "product_name", "category",
        F.coalesce("cost_price", no_cost).alias("cost_price"),
    )


def products_plan() -> CleanPlan:
    return CleanPlan(
        S.DIM_PRODUCTS.name,
        "product_id",
        {
            "product_id": F.col("product_id"),
            "product_name": F.col("product_name"),
            "category": F.col("category"),
            "cost_price": F.col("cost_price").try_cast("decimal(10,2)"),
        },
        parsed={"cost_price": "cost_price"},
    )
