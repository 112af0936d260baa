"""fact_orders and fact_order_items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.stamps import parse_stamp
from patronlake.functions.vocab import remap
from patronlake.operators.cleaning import CleanPlan, clean_rows


def orders_plan(raw: DataFrame) -> CleanPlan:
    return CleanPlan(
        table=S.FACT_ORDERS.name,
        key="order_id",
        columns={
            "order_id": F.col("order_id"),
            "user_id": F.col("user_id"),
            "total_amount": F.col("total_amount").try_cast("decimal(18,2)"),
            "order_status": remap(F.col("order_status"), S.STATUS_ALIASES, S.ORDER_STATUSES),
            "payment_method": remap(F.col("payment_method"), S.PAYMENT_ALIASES, S.PAYMENT_METHODS),
            "created_at": parse_stamp(F.col("created_at"), raw.schema["created_at"].dataType),
        },
        parsed={"total_amount": "total_amount", "created_at": "created_at"},
        remapped={"order_status": "order_status", "payment_method": "payment_method"},
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    return clean_rows(raw, orders_plan(raw))


def price_column(items: DataFrame) -> str:
    return "unit_price" if "unit_price" in items.columns else "price"


def _item_key(raw: DataFrame) -> Column:
    if "item_id" in raw.columns:
        return F.col("item_id")
    # concat_ws leaves out NULL parts.
    return F.concat_ws("_", F.col("order_id"), F.col("order_item_id").cast("string"))


def order_items_plan(raw: DataFrame) -> CleanPlan:
    """Both shapes: keyed items with unit_price, and marketplace items with order_item_id + price."""
    price = price_column(raw)
    columns = {
        "item_id": _item_key(raw),
        "order_id": F.col("order_id"),
        "product_id": F.col("product_id"),
        "quantity": F.lit(1).cast("short"),
        "unit_price": F.col(price).try_cast("decimal(12,2)"),
    }
    parsed = {"unit_price": price}
    if "quantity" in raw.columns:
        columns["quantity"] = F.col("quantity").try_cast("short")
        parsed["quantity"] = "quantity"
    key = "item_id" if "item_id" in raw.columns else "order_id"
    return CleanPlan(S.FACT_ORDER_ITEMS.name, key, columns, parsed)


def clean_order_items(raw: DataFrame) -> DataFrame:
    return clean_rows(raw, order_items_plan(raw))
