"""Common table expressions: raw shapes and the clean layer."""

from __future__ import annotations

from patronlake.functions import pseudonyms
from patronlake.functions.text import ACCENTED, UNACCENTED
from patronlake.sources import shapes


def _shape(origin: str, expressions: dict[str, str]) -> str:
    columns = ", ".join(
        f'{sql.replace("{NTZ}", "TIMESTAMP")} AS "{name}"' for name, sql in expressions.items()
    )
    return f"SELECT {columns} FROM {origin}"


def _cents_mean(total: str, count: str, numerator: int, denominator: int) -> str:
    """numerator/denominator · total/count rounded half up to cents, in whole numbers."""
    return (
        f"CAST((({2 * numerator} * CAST({total} * 100 AS HUGEINT) + {denominator} * {count}) "
        f"// ({2 * denominator} * {count})) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))"
    )


COST = _cents_mean("sum(unit_price)", "count(unit_price)", 7, 10)
MEAN = _cents_mean("sum(total_amount)", "count(total_amount)", 1, 1)

CLEAN = {
    "fact_orders": """
SELECT order_id, user_id, total_amount,
  CASE WHEN order_status IN ('Pending','Processing','Completed','Cancelled') THEN order_status
       WHEN order_status = 'created' THEN 'Pending'
       WHEN order_status IN ('approved','processing','invoiced','shipped') THEN 'Processing'
       WHEN order_status = 'delivered' THEN 'Completed'
       WHEN order_status IN ('canceled','unavailable') THEN 'Cancelled' END AS order_status,
  CASE payment_method WHEN 'credit_card' THEN 'Credit Card' WHEN 'boleto' THEN 'Bank Slip'
       WHEN 'voucher' THEN 'Voucher' WHEN 'debit_card' THEN 'Debit Card'
       WHEN 'Credit Card' THEN 'Credit Card' WHEN 'Bank Slip' THEN 'Bank Slip'
       WHEN 'Voucher' THEN 'Voucher' WHEN 'Debit Card' THEN 'Debit Card' END AS payment_method,
  created_at
FROM raw_orders""",
    "fact_order_items": """
SELECT order_id || '_' || order_item_id AS item_id, order_id, product_id, quantity,
  price AS unit_price
FROM raw_order_items""",
    "product_cost": f"""
SELECT product_id, CAST({COST} AS DECIMAL(10,2)) AS cost_price
FROM fact_order_items GROUP BY product_id""",
    "dim_products": """
SELECT p.product_id, product_name, category,
  coalesce(cost_price, CAST(0 AS DECIMAL(10,2))) AS cost_price
FROM raw_products p LEFT JOIN product_cost c ON p.product_id = c.product_id""",
    "user_spend": """
SELECT user_id, sum(total_amount) AS total_spend FROM raw_orders
WHERE order_status = 'Completed' OR order_status = 'delivered' GROUP BY user_id""",
    "thresholds": """
SELECT quantile_disc(total_spend, 0.65) AS silver, quantile_disc(total_spend, 0.85) AS gold,
  quantile_disc(total_spend, 0.95) AS platinum
FROM user_spend""",
    "dim_users": """
SELECT u.user_id, full_name, email, phone_number, customer_city, customer_state,
  CASE WHEN s.user_id IS NULL THEN NULL
       WHEN total_spend >= (SELECT platinum FROM thresholds) THEN 'Platinum'
       WHEN total_spend >= (SELECT gold FROM thresholds) THEN 'Gold'
       WHEN total_spend >= (SELECT silver FROM thresholds) THEN 'Silver'
       ELSE 'Bronze' END AS loyalty_tier,
  coalesce(f.first_order, u.created_at) AS created_at
FROM raw_users u
LEFT JOIN (SELECT user_id, min(created_at) AS first_order FROM raw_orders GROUP BY user_id) f
  ON u.user_id = f.user_id
LEFT JOIN user_spend s ON u.user_id = s.user_id""",
    "dim_users_validated": """
SELECT user_id, full_name, email, phone_number, customer_city, customer_state,
  CASE WHEN loyalty_tier IN ('Bronze','Silver','Gold','Platinum') THEN loyalty_tier END
    AS loyalty_tier, created_at
FROM raw_tiered_users""",
    "fact_events_log": """
SELECT event_id, "timestamp", user_id, session_id, event_type, product_id, device_os,
  time_spent_seconds
FROM raw_events WHERE event_type IN ('view_item','add_to_cart','cart_abandonment')""",
    "fact_cs_tickets": r"""
SELECT "Ticket_ID" AS ticket_id, "Order_ID" AS order_id,
  CASE WHEN regexp_matches("Customer_Email", '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$')
       THEN lower(trim("Customer_Email")) END AS customer_email,
  CASE WHEN "Issue_Type" IN ('Product Issue','General Inquiry','Positive Feedback')
         THEN "Issue_Type"
       WHEN "Customer_Rating" IN (1,2) THEN 'Product Issue'
       WHEN "Customer_Rating" = 3 THEN 'General Inquiry'
       WHEN "Customer_Rating" IN (4,5) THEN 'Positive Feedback' END AS issue_category,
  coalesce(nullif(trim("Status"), ''), 'Unknown') AS status,
  "Customer_Rating" AS rating, "Reported_Date" AS reported_at
FROM raw_tickets""",
    "order_agg": """
SELECT user_id, sum(total_amount) AS ltv, count(order_id) AS orders, max(created_at) AS last_order
FROM fact_orders WHERE order_status = 'Completed' GROUP BY user_id""",
    "carts": """
SELECT user_id, count(event_id) AS carts FROM fact_events_log
WHERE event_type = 'cart_abandonment' GROUP BY user_id""",
    "last_events": """
SELECT user_id, max("timestamp") AS last_event FROM fact_events_log GROUP BY user_id""",
    "complaints": """
SELECT o.user_id, count(t.ticket_id) AS complaints
FROM fact_cs_tickets t JOIN fact_orders o ON t.order_id = o.order_id
WHERE t.issue_category = 'Product Issue' GROUP BY o.user_id""",
    "customer_360": """
SELECT u.user_id, full_name, customer_city, customer_state, loyalty_tier,
  CAST(coalesce(ltv, 0) AS DECIMAL(18,2)) AS total_lifetime_value,
  CAST(coalesce(orders, 0) AS INTEGER) AS total_orders_completed,
  CAST(coalesce(carts, 0) AS INTEGER) AS total_abandoned_carts,
  CAST(coalesce(complaints, 0) AS INTEGER) AS total_cs_complaints,
  greatest(last_order, last_event) AS last_active_date,
  CAST(NULL AS FLOAT) AS churn_risk_score
FROM dim_users u
LEFT JOIN order_agg a ON u.user_id = a.user_id
LEFT JOIN carts c ON u.user_id = c.user_id
LEFT JOIN last_events e ON u.user_id = e.user_id
LEFT JOIN complaints p ON u.user_id = p.user_id""",
}


def _quoted(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _digest_mod(entity: str, digits: int, modulus: int) -> str:
    """Remainder folded digit by digit."""
    return (
        f"list_reduce(list_transform(string_split(left(md5({entity}), {digits}), ''), "
        f"lambda d: CAST('0x' || d AS BIGINT)), lambda a, d: (a * 16 + d) % {modulus}, "
        f"CAST(0 AS BIGINT))"
    )


def _hex(text: str) -> str:
    return f"CAST('0x' || {text} AS BIGINT)"


def pseudonym_columns(entity: str) -> dict[str, str]:
    first = f"{_quoted(pseudonyms.FIRST_NAMES)}[{_digest_mod(entity, 32, 36)} + 1]"
    last = f"{_quoted(pseudonyms.LAST_NAMES)}[{_digest_mod(entity, 30, 28)} + 1]"
    name = f"({first} || ' ' || {last})"
    domain = f"{_quoted(pseudonyms.EMAIL_DOMAINS)}[{_hex(f'left(md5({entity}), 8)')} % 5 + 1]"
    local = f"translate(replace(lower({name}), ' ', '.'), '{ACCENTED}', '{UNACCENTED}')"
    h = _hex(f"left(md5({entity}), 12)")
    return {
        "full_name": name,
        "email": f"{local} || '.' || left({entity}, 4) || '@' || {domain}",
        "phone_number": f"'+55 ' || CAST(11 + {h} % 79 AS VARCHAR) || ' ' || "
        f"CAST(900000000 + {h} % 100000000 AS VARCHAR)",
    }


_TITLE = (
    "CASE WHEN {w} <> '' THEN list_reduce(list_prepend('', string_split({w}, '')), lambda a, ch: a || "
    "CASE WHEN regexp_matches(a, '[A-Za-z]$') THEN lower(ch) ELSE upper(ch) END) END"
)

MARKET = {
    "translations": f"""
SELECT product_category_name, arg_max(product_category_name_english, file_row) AS english
FROM ({_shape('part', shapes.MARKET_TRANSLATIONS)})
WHERE trim(product_category_name_english) <> '' GROUP BY product_category_name""",
    "owned_orders": """
SELECT o.*, c.customer_unique_id IS NOT NULL AS known_customer,
  coalesce(c.customer_unique_id, o.customer_id) AS user_id
FROM mk_orders o LEFT JOIN mk_customers c ON o.customer_id = c.customer_id""",
    "paid": """
SELECT order_id, CAST(sum(TRY_CAST(payment_value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS paid
FROM mk_payments GROUP BY order_id""",
    "first_payment": """
SELECT order_id, CASE payment_type WHEN 'boleto' THEN 'Bank Slip' WHEN 'voucher' THEN 'Voucher'
  WHEN 'debit_card' THEN 'Debit Card' ELSE 'Credit Card' END AS method
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY file_row DESC) AS nth
  FROM mk_payments WHERE payment_sequential = '1') WHERE nth = 1""",
    "payments_per_user": """
SELECT user_id, sum(paid) AS total_spend FROM owned_orders JOIN paid USING (order_id)
WHERE known_customer AND paid IS NOT NULL GROUP BY user_id""",
    "spend_ranks": """
SELECT total_spend, row_number() OVER (ORDER BY total_spend) - 1 AS idx, count(*) OVER () AS n
FROM payments_per_user""",
    "shifted": """
SELECT order_id, CASE
  WHEN regexp_matches(trim(order_purchase_timestamp), '^\\d{4}-\\d\\d-\\d\\d$')
    THEN strftime(CAST(order_purchase_timestamp AS TIMESTAMP) + INTERVAL {days} DAY
      + INTERVAL {seconds} SECOND, '%Y-%m-%d')
  WHEN regexp_matches(order_purchase_timestamp, 'Z$')
    THEN strftime(CAST(replace(order_purchase_timestamp, 'Z', '') AS TIMESTAMP)
      + INTERVAL {days} DAY + INTERVAL {seconds} SECOND, '%Y-%m-%dT%H:%M:%S.%fZ')
  WHEN regexp_matches(order_purchase_timestamp, 'T')
    THEN strftime(CAST(order_purchase_timestamp AS TIMESTAMP) + INTERVAL {days} DAY
      + INTERVAL {seconds} SECOND, '%Y-%m-%dT%H:%M:%S')
  WHEN regexp_matches(order_purchase_timestamp, '\\d')
    THEN strftime(CAST(order_purchase_timestamp AS TIMESTAMP) + INTERVAL {days} DAY
      + INTERVAL {seconds} SECOND, '%Y-%m-%d %H:%M:%S')
  ELSE order_purchase_timestamp END AS created_at
FROM mk_orders""".replace("\\\\", "\\"),
    "staged_products": f"""
SELECT product_id,
  coalesce({_TITLE.format(w='w')} || ' Item #', 'Product #')
    || CAST(CAST('0x' || left(md5(product_id), 6) AS BIGINT) % 10000 AS VARCHAR) AS product_name,
  {_TITLE.format(w='w')} AS category
FROM (SELECT product_id, replace(coalesce(english, p.product_category_name), '_', ' ') AS w
  FROM mk_products p LEFT JOIN translations t
    ON p.product_category_name = t.product_category_name)""",
}


def _with(ctes: dict[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n"


def clean_prefix() -> str:
    raw = {name: _shape(*shape) for name, shape in shapes.RAW_SHAPES.items()}
    return _with({**raw, **CLEAN})


def market_prefix(days: int, seconds: int) -> str:
    raw = {name: _shape(*shape) for name, shape in shapes.MARKET_SHAPES.items()}
    staged = {
        name: sql.replace("{days}", str(days)).replace("{seconds}", str(seconds))
        for name, sql in MARKET.items()
    }
    return _with({**raw, **staged})
