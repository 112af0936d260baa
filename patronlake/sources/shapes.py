"""Benchmark tables expressed in the source systems' raw shapes.

Each shape is a set of row-wise SQL expressions over one driver table (or one small join). The
expressions are valid in Spark and in the SQL oracle alike, so both sides read the same input.
``{NTZ}`` stands for the zone-less stamp type. No row is left out: every shape covers its table.
"""

from __future__ import annotations

_USER_ID = "CAST(user_id AS STRING)"
_ITEM_PRODUCT = (
    "CASE WHEN l_partkey % 50 = 49 THEN concat('delisted-', CAST(l_partkey AS STRING)) "
    "ELSE CAST(l_partkey AS STRING) END"
)
_STATUS_WORD = """CASE o_orderstatus
  WHEN 'F' THEN 'delivered'
  WHEN 'O' THEN CASE o_orderkey % 5 WHEN 0 THEN 'created' WHEN 1 THEN 'approved'
    WHEN 2 THEN 'processing' WHEN 3 THEN 'invoiced' ELSE 'shipped' END
  ELSE CASE o_orderkey % 4 WHEN 0 THEN 'canceled' WHEN 1 THEN 'unavailable'
    WHEN 2 THEN 'Completed' ELSE 'mystery' END END"""
_ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

CUSTOMER_PLACES = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"

USERS = {
    "user_id": "CAST(c_custkey AS STRING)",
    "full_name": "c_name",
    "email": "CAST(NULL AS STRING)",
    "phone_number": "CAST(NULL AS STRING)",
    "customer_city": "n_name",
    "customer_state": "r_name",
    "created_at": "CAST('1995-01-01 00:00:00' AS {NTZ})",
}
# The same users as a source that brings tiers, one of them unknown.
TIERED_USERS = {
    **USERS,
    "loyalty_tier": "CASE c_custkey % 6 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' "
    "WHEN 2 THEN 'Gold' WHEN 3 THEN 'Platinum' WHEN 4 THEN 'Diamond' END",
}
PRODUCTS = {
    "product_id": "CAST(p_partkey AS STRING)",
    "product_name": "p_name",
    "category": "CASE WHEN p_size % 10 <> 0 THEN p_type END",
}
ORDERS = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "user_id": "CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_custkey AS STRING) END",
    "total_amount": "CAST(o_totalprice AS DECIMAL(18,2))",
    "order_status": _STATUS_WORD,
    "payment_method": "CASE WHEN o_orderkey % 101 = 0 THEN 'crypto' "
    "ELSE CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'boleto' "
    "WHEN '3' THEN 'voucher' WHEN '5' THEN 'Debit Card' END END",
    "created_at": "o_orderdate",
}
# Items of delisted parts keep their row but name a product outside the catalogue, so some
# products are unsold and some items find no product.
ORDER_ITEMS = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "order_item_id": "CAST(l_linenumber AS STRING)",
    "product_id": _ITEM_PRODUCT,
    "quantity": "CAST(l_quantity AS SMALLINT)",
    "price": "CAST(l_extendedprice AS DECIMAL(12,2))",
}
EVENTS = {
    "event_id": "CAST(event_id AS STRING)",
    "timestamp": "ts",
    "user_id": f"CASE WHEN event_id % 20 <> 0 THEN {_USER_ID} END",
    "session_id": f"concat({_USER_ID}, '-', replace(CAST(CAST(ts AS DATE) AS STRING), '-', ''))",
    "event_type": "CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart' "
    "WHEN 'error' THEN 'cart_abandonment' ELSE event_type END",
    "product_id": "CASE WHEN event_id % 7 <> 0 THEN regexp_extract(props, '([0-9]+)', 1) END",
    "device_os": "CASE event_id % 6 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Windows' "
    "WHEN 3 THEN 'macOS' WHEN 4 THEN 'Unknown' END",
    "time_spent_seconds": "CASE WHEN event_id % 50 <> 1 THEN CAST(floor(value) AS INT) END",
}
TICKETS = {
    "Ticket_ID": "CAST(doc_id AS STRING)",
    "Order_ID": "CASE WHEN doc_id % 17 <> 0 THEN CAST(doc_id AS STRING) END",
    "Customer_Email": """CASE WHEN doc_id % 23 = 0 THEN NULL
      WHEN doc_id % 40 = 0 THEN concat('user', CAST(doc_id AS STRING), '@mailexamplecom')
      WHEN doc_id % 20 = 0 THEN concat('user', CAST(doc_id AS STRING), 'mail.example.com')
      WHEN doc_id % 13 = 0 THEN concat(' User', CAST(doc_id AS STRING), '@mail.example.com')
      WHEN doc_id % 31 = 0 THEN concat('User', CAST(doc_id AS STRING), '@gmal.com')
      ELSE concat('User', CAST(doc_id AS STRING), '@Mail.example.com') END""",
    "Issue_Type": "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'garbage' "
    "ELSE CASE doc_id % 3 WHEN 0 THEN 'Product Issue' WHEN 1 THEN 'General Inquiry' "
    "ELSE 'Positive Feedback' END END",
    "Status": "CASE doc_id % 5 WHEN 1 THEN '' WHEN 2 THEN ' Open ' WHEN 3 THEN 'Open' "
    "WHEN 4 THEN 'Resolved' END",
    "Customer_Rating": "CASE WHEN doc_id % 11 <> 0 THEN CAST(1 + doc_id % 5 AS INT) END",
    "Reported_Date": "CAST(DATE '1998-01-01' + CAST(doc_id % 120 AS INT) AS {NTZ})",
}

# The same tables as text sources bring them, some values of which cannot be read.
TEXT_USERS = {
    **TIERED_USERS,
    "created_at": "CASE WHEN c_custkey % 37 = 0 THEN 'last spring' WHEN c_custkey % 2 = 0 "
    "THEN '1995-01-01T00:00:00+02:00' ELSE '1995-01-01 00:00:00' END",
}
TEXT_PRODUCTS = {
    **PRODUCTS,
    "cost_price": "CASE WHEN p_partkey % 29 = 0 THEN 'n/a' "
    "ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END",
}
TEXT_ORDERS = {
    **ORDERS,
    "total_amount": "CASE WHEN o_orderkey % 67 = 0 THEN '12,50' "
    "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
    "created_at": "CASE WHEN o_orderkey % 71 = 0 THEN '31/12/1997' "
    "ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:00:00') END",
}
TEXT_ORDER_ITEMS = {
    **ORDER_ITEMS,
    "quantity": "CASE WHEN l_orderkey % 73 = 0 THEN '99999' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "price": "CASE WHEN l_orderkey % 79 = 0 THEN 'free' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
}
TEXT_EVENTS = {
    **EVENTS,
    "timestamp": "CASE WHEN event_id % 83 = 0 THEN '2024-01-05T10:00:00' "
    "ELSE concat(CAST(CAST(ts AS DATE) AS STRING), 'T08:30:15.250Z') END",
    "time_spent_seconds": "CASE WHEN event_id % 89 = 0 THEN 'abc' WHEN event_id % 97 = 0 THEN '99999999999' "
    "ELSE CAST(CAST(floor(value) AS INT) AS STRING) END",
}

# Marketplace exports: what the source systems hold before they are staged. Two accounts share one
# person; some orders name an account that is not in the customer file; stamps come in four
# shapes; amounts, scores and words are partly unreadable.
MARKET_CUSTOMERS = {
    "customer_id": "concat('c', CAST(c_custkey AS STRING))",
    "customer_unique_id": "concat('person-', CAST(c_custkey - c_custkey % 2 AS STRING))",
    "customer_city": "n_name",
    "customer_state": "r_name",
    "file_row": "c_custkey",
}
MARKET_ORDERS = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "customer_id": "concat(CASE WHEN o_orderkey % 97 = 0 THEN 'walk-in-' ELSE 'c' END, "
    "CAST(o_custkey AS STRING))",
    "order_status": _STATUS_WORD,
    "order_purchase_timestamp": f"""CASE
      WHEN o_orderkey % 61 = 0 THEN 'unknown'
      WHEN o_orderkey % 59 = 0 THEN ' '
      WHEN o_orderkey % 4 = 1 THEN concat({_ORDER_DAY}, 'T08:30:15.25Z')
      WHEN o_orderkey % 4 = 2 THEN concat({_ORDER_DAY}, 'T21:05:09')
      WHEN o_orderkey % 4 = 3 THEN {_ORDER_DAY}
      ELSE concat({_ORDER_DAY}, ' 13:45:00') END""",
}
MARKET_PAYMENTS = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "payment_sequential": "CAST(l_linenumber AS STRING)",
    "payment_type": "CASE l_suppkey % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' "
    "WHEN 2 THEN 'voucher' WHEN 3 THEN 'debit_card' ELSE 'not_defined' END",
    "payment_value": "CASE WHEN l_partkey % 41 = 0 THEN 'n/a' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
    # Line and part make the place in the file; equal places of an order hold equal methods.
    "file_row": "CAST(l_suppkey AS BIGINT) * 1000 + l_linenumber",
}
MARKET_ITEMS = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "order_item_id": "CAST(l_linenumber AS STRING)",
    "product_id": "CAST(l_partkey AS STRING)",
    "price": "CASE WHEN l_partkey % 43 = 0 THEN 'free' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
}
MARKET_PRODUCTS = {
    "product_id": "CAST(p_partkey AS STRING)",
    "product_category_name": "CASE WHEN p_size % 10 <> 0 "
    "THEN concat(lower(p_type), '_', lower(p_brand), 'x_', replace(p_name, ' ', '_')) END",
}
# A category has a row for each of its parts, with translations for the odd sizes only.
MARKET_TRANSLATIONS = {
    "product_category_name": MARKET_PRODUCTS["product_category_name"],
    "product_category_name_english": "CASE WHEN p_size % 2 = 1 "
    "THEN concat(replace(p_name, ' ', '_'), '_in_', CAST(p_size AS STRING), '_', lower(p_type)) END",
    "file_row": "CAST(p_partkey AS BIGINT)",
}
MARKET_REVIEWS = {
    "review_id": "CAST(doc_id AS STRING)",
    "order_id": "CASE WHEN doc_id % 17 <> 0 THEN CAST(doc_id AS STRING) END",
    "review_score": "CASE WHEN doc_id % 7 = 0 THEN 'five' WHEN doc_id % 29 = 0 THEN NULL "
    "ELSE CAST(doc_id % 9 - 1 AS STRING) END",
    "review_creation_date": "CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' "
    "WHEN 2 THEN '2018-02-11' ELSE '2018-02-10 00:00:00' END",
    "review_answer_timestamp": "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' "
    "ELSE '2018-03-01 10:00:00' END",
}

# name → (FROM clause, expressions)
RAW_SHAPES = {
    "raw_users": (CUSTOMER_PLACES, USERS),
    "raw_tiered_users": (CUSTOMER_PLACES, TIERED_USERS),
    "raw_products": ("part", PRODUCTS),
    "raw_orders": ("orders", ORDERS),
    "raw_order_items": ("lineitem", ORDER_ITEMS),
    "raw_events": ("events", EVENTS),
    "raw_tickets": ("documents", TICKETS),
    "text_users": (CUSTOMER_PLACES, TEXT_USERS),
    "text_products": ("part", TEXT_PRODUCTS),
    "text_orders": ("orders", TEXT_ORDERS),
    "text_order_items": ("lineitem", TEXT_ORDER_ITEMS),
    "text_events": ("events", TEXT_EVENTS),
}
MARKET_SHAPES = {
    "mk_customers": (CUSTOMER_PLACES, MARKET_CUSTOMERS),
    "mk_orders": ("orders", MARKET_ORDERS),
    "mk_payments": ("lineitem", MARKET_PAYMENTS),
    "mk_items": ("lineitem", MARKET_ITEMS),
    "mk_products": ("part", MARKET_PRODUCTS),
    "mk_reviews": ("documents", MARKET_REVIEWS),
}
