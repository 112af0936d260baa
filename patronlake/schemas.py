"""Table definitions, vocabularies and physical layout of the star schema.

All stamps in the clean layer are ``timestamp_ntz`` holding the UTC wall clock, so no result depends
on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The vocabularies of the source systems and the warehouse.
STATUS_ALIASES = {
    "created": "Pending",
    "approved": "Processing",
    "processing": "Processing",
    "invoiced": "Processing",
    "shipped": "Processing",
    "delivered": "Completed",
    "canceled": "Cancelled",
    "unavailable": "Cancelled",
}
ORDER_STATUSES = ["Pending", "Processing", "Completed", "Cancelled"]
PAYMENT_ALIASES = {
    "credit_card": "Credit Card",
    "boleto": "Bank Slip",
    "voucher": "Voucher",
    "debit_card": "Debit Card",
}
PAYMENT_METHODS = ["Credit Card", "Bank Slip", "Voucher", "Debit Card"]
LOYALTY_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
EVENT_TYPES = ["view_item", "add_to_cart", "cart_abandonment"]
ISSUE_CATEGORIES = ["Product Issue", "General Inquiry", "Positive Feedback"]
COMPLETED = "Completed"
ABANDONED = "cart_abandonment"
COMPLAINT = "Product Issue"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
EVENT_STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Global sums get the widest decimal so that they cannot overflow however large the tables grow.
MONEY_TOTAL = "decimal(38,2)"


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


_STR, _INT, _SHORT, _NTZ = T.StringType(), T.IntegerType(), T.ShortType(), T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    """One warehouse table: types, nullability, zone, sort key and optional month partitioning."""

    name: str
    schema: T.StructType
    sort_key: tuple[str, ...]
    zone: str = "clean"
    month_of: str | None = None
    replace_key: str | None = None
    whole_seconds: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


DIM_USERS = TableSpec(
    "dim_users",
    _schema(
        ("user_id", _STR, False),
        ("full_name", _STR, False),
        ("email", _STR, True),
        ("phone_number", _STR, True),
        ("customer_city", _STR, False),
        ("customer_state", _STR, False),
        ("loyalty_tier", _STR, True),
        ("created_at", _NTZ, False),
    ),
    sort_key=("user_id",),
    whole_seconds=("created_at",),
)
DIM_PRODUCTS = TableSpec(
    "dim_products",
    _schema(
        ("product_id", _STR, False),
        ("product_name", _STR, False),
        ("category", _STR, True),
        ("cost_price", T.DecimalType(10, 2), False),
    ),
    sort_key=("product_id",),
)
FACT_ORDERS = TableSpec(
    "fact_orders",
    _schema(
        ("order_id", _STR, False),
        ("user_id", _STR, True),
        ("total_amount", T.DecimalType(18, 2), False),
        ("order_status", _STR, False),
        ("payment_method", _STR, True),
        ("created_at", _NTZ, False),
    ),
    sort_key=("created_at", "order_id"),
    month_of="created_at",
    whole_seconds=("created_at",),
)
FACT_ORDER_ITEMS = TableSpec(
    "fact_order_items",
    _schema(
        ("item_id", _STR, False),
        ("order_id", _STR, False),
        ("product_id", _STR, False),
        ("quantity", _SHORT, False),
        ("unit_price", T.DecimalType(12, 2), False),
    ),
    sort_key=("order_id", "product_id"),
)
FACT_EVENTS_LOG = TableSpec(
    "fact_events_log",
    _schema(
        ("event_id", _STR, False),
        ("timestamp", _NTZ, False),
        ("user_id", _STR, True),
        ("session_id", _STR, False),
        ("event_type", _STR, False),
        ("product_id", _STR, True),
        ("device_os", _STR, True),
        ("time_spent_seconds", _INT, True),
    ),
    sort_key=("event_type", "timestamp", "event_id"),
    month_of="timestamp",
)
FACT_CS_TICKETS = TableSpec(
    "fact_cs_tickets",
    _schema(
        ("ticket_id", _STR, False),
        ("order_id", _STR, True),
        ("customer_email", _STR, True),
        ("issue_category", _STR, True),
        ("status", _STR, False),
        ("rating", _INT, True),
        ("reported_at", _NTZ, False),
    ),
    sort_key=("reported_at", "ticket_id"),
    whole_seconds=("reported_at",),
)
CUSTOMER_360 = TableSpec(
    "customer_360",
    _schema(
        ("user_id", _STR, False),
        ("full_name", _STR, False),
        ("customer_city", _STR, False),
        ("customer_state", _STR, False),
        ("loyalty_tier", _STR, True),
        ("total_lifetime_value", T.DecimalType(18, 2), False),
        ("total_orders_completed", _INT, False),
        ("total_abandoned_carts", _INT, False),
        ("total_cs_complaints", _INT, False),
        ("last_active_date", _NTZ, True),
        ("churn_risk_score", T.FloatType(), True),
    ),
    sort_key=("user_id",),
    zone="serving",
    replace_key="user_id",
    whole_seconds=("last_active_date",),
)

# In load order.
TABLES = {
    spec.name: spec
    for spec in (
        DIM_USERS,
        DIM_PRODUCTS,
        FACT_ORDERS,
        FACT_ORDER_ITEMS,
        FACT_EVENTS_LOG,
        FACT_CS_TICKETS,
        CUSTOMER_360,
    )
}

# Raw record shapes. Text sources are read as strings; the cleaners do the typing.
CLICKSTREAM_JSON = _schema(
    ("event_id", _STR, True),
    ("timestamp", _STR, True),
    ("user_id", _STR, True),
    ("session_id", _STR, True),
    ("event_type", _STR, True),
    ("product_id", _STR, True),
    ("device_os", _STR, True),
    ("time_spent_seconds", _STR, True),
)
TICKET_CSV = _schema(
    ("Ticket_ID", _STR, True),
    ("Order_ID", _STR, True),
    ("Customer_Email", _STR, True),
    ("Issue_Type", _STR, True),
    ("Status", _STR, True),
    ("Customer_Rating", _STR, True),
    ("Reported_Date", _STR, True),
)
