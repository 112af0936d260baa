"""One SQL statement per registered query."""

from __future__ import annotations

import datetime as dt

from patronlake import parameters as P
from patronlake.functions.periods import month_bounds
from patronlake.functions.stamps import HISTORY_END
from patronlake.oracle.tables import MEAN, clean_prefix, market_prefix, pseudonym_columns
from patronlake.schemas import TABLES

CUSTOMER_COLUMNS = """user_id, full_name, customer_city, customer_state, loyalty_tier,
  total_lifetime_value, total_orders_completed, total_abandoned_carts, total_cs_complaints,
  last_active_date"""


def _in(stamp: str, month: str) -> str:
    first, following = month_bounds(month)
    return f"{stamp} >= TIMESTAMP '{first} 00:00:00' AND {stamp} < TIMESTAMP '{following} 00:00:00'"


def _revenue(period: str) -> str:
    return f"""SELECT CAST(date_trunc('{period}', created_at) AS DATE) AS period,
  CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue, count(*) AS order_count
FROM fact_orders WHERE order_status = 'Completed' GROUP BY 1"""


def _number_label(n: str) -> str:
    return f"""CASE WHEN {n} IS NULL THEN '0'
  WHEN {n} >= 1000000 THEN printf('%.1fM', CAST({n} AS DOUBLE) / 1000000)
  WHEN {n} >= 1000 THEN printf('%.1fK', CAST({n} AS DOUBLE) / 1000)
  ELSE CAST({n} AS VARCHAR) END AS {n}_label"""


def _serving() -> dict[str, str]:
    orders_month = _in("created_at", P.ORDER_MONTH)
    events_month = _in('"timestamp"', P.EVENT_MONTH)
    tickets_month = _in("reported_at", P.TICKET_MONTH)
    count = {
        "total_customers": "dim_users",
        "total_orders": "fact_orders",
        "total_events": "fact_events_log",
        "total_tickets": "fact_cs_tickets",
        "total_products": "dim_products",
    }
    statements = {
        key: f"SELECT count(*) AS {key} FROM {table}" for key, table in count.items()
    }
    statements["total_revenue"] = """SELECT
  CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) AS total_revenue
FROM fact_orders WHERE order_status = 'Completed'"""
    statements["kpi_overview"] = f"""SELECT *,
  {', '.join(_number_label(k) for k in count)},
  'R$ ' || CASE WHEN total_revenue IS NULL THEN '0'
    WHEN total_revenue >= 1000000 THEN printf('%.2fM', CAST(total_revenue AS DOUBLE) / 1000000)
    WHEN total_revenue >= 1000 THEN printf('%.1fK', CAST(total_revenue AS DOUBLE) / 1000)
    ELSE printf('%.2f', CAST(total_revenue AS DOUBLE)) END AS total_revenue_label
FROM (SELECT {', '.join(f'({sql}) AS {key}' for key, sql in statements.items())})"""
    for period in ("day", "month", "year"):
        statements[f"revenue_by_{period}"] = _revenue(period)
    statements["revenue_by_month_label"] = f"""SELECT *, left(CAST(period AS VARCHAR), 7) AS label
FROM ({_revenue('month')})"""

    def grouped(table: str, columns: str, where: str = "true") -> str:
        return f"SELECT {columns}, count(*) AS cnt FROM {table} WHERE {where} GROUP BY ALL"

    for suffix, where in (("", "true"), ("_in_month", orders_month)):
        statements[f"orders_by_status{suffix}"] = grouped("fact_orders", "order_status", where)
        statements[f"revenue_by_payment{suffix}"] = f"""SELECT payment_method,
  CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue, count(*) AS order_count
FROM fact_orders WHERE payment_method IS NOT NULL AND {where} GROUP BY payment_method"""
        statements[f"top_products{suffix}"] = f"""SELECT p.product_name, p.category,
  CAST(sum(i.unit_price * i.quantity) AS DECIMAL(38,2)) AS revenue,
  CAST(sum(i.quantity) AS BIGINT) AS units_sold
FROM fact_order_items i JOIN dim_products p ON i.product_id = p.product_id
{'' if not suffix else f'JOIN fact_orders o ON i.order_id = o.order_id AND {where}'}
GROUP BY p.product_name, p.category ORDER BY revenue DESC, p.product_name, p.category LIMIT 10"""
    for suffix, where in (("", "true"), ("_in_month", events_month)):
        statements[f"events_by_type{suffix}"] = grouped("fact_events_log", "event_type", where)
        statements[f"events_by_day{suffix}"] = grouped(
            "fact_events_log", 'CAST("timestamp" AS DATE) AS day, event_type', where
        )
    for suffix, where in (("", "true"), ("_in_month", tickets_month)):
        statements[f"tickets_by_category{suffix}"] = grouped(
            "fact_cs_tickets", "coalesce(issue_category, 'Uncategorized') AS category", where
        )
        statements[f"tickets_by_status{suffix}"] = grouped("fact_cs_tickets", "status", where)
        statements[f"tickets_by_day{suffix}"] = grouped(
            "fact_cs_tickets", "CAST(reported_at AS DATE) AS day", where
        )
    statements["loyalty_distribution"] = grouped(
        "dim_users", "coalesce(loyalty_tier, 'No Tier') AS tier"
    )
    statements["device_distribution"] = """SELECT device_os, count(*) AS cnt FROM
  (SELECT coalesce(device_os, 'Unknown') AS device_os FROM fact_events_log) GROUP BY device_os"""
    for key, table, stamp in (
        ("order", "fact_orders", "created_at"),
        ("event", "fact_events_log", '"timestamp"'),
        ("ticket", "fact_cs_tickets", "reported_at"),
    ):
        statements[f"available_{key}_months"] = (
            f"SELECT DISTINCT CAST(date_trunc('month', {stamp}) AS DATE) AS month FROM {table}"
        )
    statements["customer_360_page"] = f"""SELECT {CUSTOMER_COLUMNS} FROM customer_360
ORDER BY total_lifetime_value DESC, user_id LIMIT {P.PAGE_LIMIT} OFFSET {P.PAGE_OFFSET}"""
    statements["customer_360_count"] = "SELECT count(*) AS total_customers FROM customer_360"
    statements["customer_360_search"] = f"""SELECT {CUSTOMER_COLUMNS} FROM customer_360
WHERE full_name ILIKE '%{P.SEARCH_TERM}%' OR user_id ILIKE '%{P.SEARCH_TERM}%'
ORDER BY total_lifetime_value DESC, user_id LIMIT 50"""
    statements["top_states"] = """SELECT u.customer_state,
  CAST(sum(o.total_amount) AS DECIMAL(38,2)) AS revenue, count(*) AS order_count
FROM fact_orders o JOIN dim_users u ON o.user_id = u.user_id
WHERE o.order_status = 'Completed'
GROUP BY u.customer_state ORDER BY revenue DESC, u.customer_state LIMIT 10"""
    statements["avg_rating_by_month"] = """SELECT
  CAST(date_trunc('month', reported_at) AS DATE) AS month,
  round_even(CAST(sum(rating) AS DOUBLE) / count(rating), 2) AS avg_rating,
  count(*) AS ticket_count
FROM fact_cs_tickets WHERE rating IS NOT NULL GROUP BY 1"""
    return statements


def _clean_layer() -> dict[str, str]:
    tables = [
        "dim_users", "dim_users_validated", "dim_products", "fact_orders", "fact_order_items",
        "fact_events_log", "fact_cs_tickets", "customer_360",
    ]
    statements = {name: f"SELECT * FROM {name}" for name in tables}
    statements["user_spend"] = """SELECT user_id,
  CAST(total_spend AS DECIMAL(28,2)) AS total_spend FROM user_spend"""
    for key, where in (("loyalty_thresholds", "true"),
                       ("loyalty_thresholds_no_guests", "user_id IS NOT NULL")):
        statements[key] = f"""SELECT
  CAST(quantile_disc(total_spend, 0.65) AS DECIMAL(28,2)) AS silver,
  CAST(quantile_disc(total_spend, 0.85) AS DECIMAL(28,2)) AS gold,
  CAST(quantile_disc(total_spend, 0.95) AS DECIMAL(28,2)) AS platinum
FROM user_spend WHERE {where}"""
    statements["loyalty_thresholds_approx"] = (
        "SELECT count(*) > 0 AS silver, count(*) > 0 AS gold, count(*) > 0 AS platinum FROM user_spend"
    )
    statements["product_cost"] = "SELECT product_id, cost_price FROM product_cost"
    statements["order_agg_by_user"] = """SELECT user_id,
  CAST(ltv AS DECIMAL(28,2)) AS total_lifetime_value, orders AS total_orders_completed,
  last_order AS last_order_at FROM order_agg WHERE user_id IS NOT NULL"""
    statements["abandoned_carts_by_user"] = (
        "SELECT user_id, carts AS total_abandoned_carts FROM carts WHERE user_id IS NOT NULL"
    )
    statements["last_event_by_user"] = (
        "SELECT user_id, last_event AS last_event_at FROM last_events WHERE user_id IS NOT NULL"
    )
    statements["complaints_by_user"] = (
        "SELECT user_id, complaints AS total_cs_complaints FROM complaints WHERE user_id IS NOT NULL"
    )
    faults = [
        ("dim_users", "user_id", "created_at", "created_at", "text_users", "created_at = 'last spring'"),
        ("dim_products", "product_id", "cost_price", "cost_price", "text_products", "cost_price = 'n/a'"),
        ("fact_orders", "order_id", "total_amount", "total_amount", "text_orders", "total_amount = '12,50'"),
        ("fact_orders", "order_id", "created_at", "created_at", "text_orders", "created_at = '31/12/1997'"),
        ("fact_order_items", "order_id", "unit_price", "price", "text_order_items", "price = 'free'"),
        ("fact_order_items", "order_id", "quantity", "quantity", "text_order_items", "quantity = '99999'"),
        ("fact_events_log", "event_id", "timestamp", "timestamp", "text_events",
         "event_type IN ('view_item','add_to_cart','cart_abandonment') AND \"timestamp\" NOT LIKE '%Z'"),
        ("fact_events_log", "event_id", "time_spent_seconds", "time_spent_seconds", "text_events",
         "event_type IN ('view_item','add_to_cart','cart_abandonment') "
         "AND time_spent_seconds IN ('abc', '99999999999')"),
    ]
    statements["quarantine"] = r"""SELECT 'fact_cs_tickets' AS table_name,
  r."Ticket_ID" AS row_key, 'customer_email' AS column_name,
  r."Customer_Email" AS raw_value, 'unreadable value' AS reason
FROM raw_tickets r JOIN fact_cs_tickets f ON r."Ticket_ID" = f.ticket_id
WHERE r."Customer_Email" IS NOT NULL AND f.customer_email IS NULL""" + "".join(
        f""" UNION ALL SELECT '{table}', {key}, '{column}', "{source}", 'unreadable value'
FROM {shape} WHERE {bad}""" for table, key, column, source, shape, bad in faults
    )
    statements["remap_drift"] = """SELECT 'fact_orders' AS table_name,
  'order_status' AS column_name, count(*) FILTER (r.order_status IS NOT NULL
    AND f.order_status IS NULL) AS unmapped
FROM raw_orders r JOIN fact_orders f USING (order_id)
UNION ALL SELECT 'fact_orders', 'payment_method',
  count(*) FILTER (r.payment_method IS NOT NULL AND f.payment_method IS NULL)
FROM raw_orders r JOIN fact_orders f USING (order_id)
UNION ALL SELECT 'dim_users', 'loyalty_tier',
  count(*) FILTER (r.loyalty_tier IS NOT NULL AND v.loyalty_tier IS NULL)
FROM raw_tiered_users r JOIN dim_users_validated v USING (user_id)"""
    return statements


def _feeds() -> dict[str, str]:
    columns = 'event_id, "timestamp", user_id, session_id, event_type, product_id, device_os, ' \
              "time_spent_seconds"
    since = f"\"timestamp\" >= TIMESTAMP '{P.EVENTS_SINCE}'"
    statements = {
        "ingest_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}"
            for t in ("users", "products", "orders", "order_items")
        ),
        "raw_event_count": "SELECT count(*) AS total_events FROM raw_events",
        "events_since": f"SELECT {columns} FROM raw_events WHERE {since}",
        "orders_by_yyyymm": """SELECT
  CAST(year(created_at) * 100 + month(created_at) AS INTEGER) AS yyyymm, count(*) AS order_count
FROM fact_orders GROUP BY 1""",
        "latest_events": f"""SELECT {columns} FROM fact_events_log
ORDER BY "timestamp" DESC, event_id DESC LIMIT 100""",
        "latest_type_counts": """SELECT event_type, count(*) AS cnt FROM
  (SELECT event_type FROM fact_events_log ORDER BY "timestamp" DESC, event_id DESC LIMIT 100)
GROUP BY event_type""",
        "session_funnel": """SELECT sessions, viewed, carted, abandoned,
  CAST(carted AS DOUBLE) / nullif(viewed, 0) AS view_to_cart,
  CAST(abandoned AS DOUBLE) / nullif(carted, 0) AS cart_to_abandon
FROM (SELECT count(*) AS sessions, count(*) FILTER (v) AS viewed,
    count(*) FILTER (v AND c) AS carted, count(*) FILTER (v AND c AND a) AS abandoned
  FROM (SELECT bool_or(event_type = 'view_item') AS v, bool_or(event_type = 'add_to_cart') AS c,
      bool_or(event_type = 'cart_abandonment') AS a
    FROM fact_events_log GROUP BY session_id))""",
    }
    statements["events_page"] = f"""SELECT {columns}, total,
  {P.EVENTS_OFFSET + P.EVENTS_LIMIT} < total AS has_more
FROM (SELECT *, count(*) OVER () AS total FROM raw_events WHERE {since})
ORDER BY "timestamp", event_id LIMIT {P.EVENTS_LIMIT} OFFSET {P.EVENTS_OFFSET}"""
    statements["events_deep_page"] = f"""SELECT {columns}, total,
  {P.EVENTS_DEEP + P.EVENTS_LIMIT} < total AS has_more
FROM (SELECT *, count(*) OVER () AS total FROM raw_events WHERE {since})
ORDER BY "timestamp", event_id LIMIT {P.EVENTS_LIMIT} OFFSET {P.EVENTS_DEEP}"""
    statements["customers_middle_page"] = f"""SELECT {CUSTOMER_COLUMNS} FROM (SELECT *,
  row_number() OVER (ORDER BY total_lifetime_value DESC NULLS LAST, user_id) - 1 AS place,
  count(*) OVER () // 2 AS half FROM customer_360)
WHERE place >= half AND place < half + {P.PAGE_LIMIT}"""
    statements["ordered_funnel"] = """SELECT * FROM (WITH e AS (SELECT session_id, event_type,
    row_number() OVER (PARTITION BY session_id ORDER BY "timestamp" NULLS LAST, event_id NULLS LAST) AS i
  FROM fact_events_log),
v AS (SELECT session_id, min(i) FILTER (event_type = 'view_item') AS v FROM e GROUP BY session_id),
c AS (SELECT v.session_id, any_value(v.v) AS v, min(e.i) AS c FROM v
  LEFT JOIN e ON e.session_id IS NOT DISTINCT FROM v.session_id AND e.event_type = 'add_to_cart' AND e.i > v.v
  GROUP BY v.session_id),
a AS (SELECT c.session_id, any_value(c.v) AS v, any_value(c.c) AS c, min(e.i) AS a FROM c
  LEFT JOIN e ON e.session_id IS NOT DISTINCT FROM c.session_id AND e.event_type = 'cart_abandonment' AND e.i > c.c
  GROUP BY c.session_id)
SELECT count(*) AS sessions, count(v) AS viewed, count(c) AS carted, count(a) AS abandoned,
  CAST(count(c) AS DOUBLE) / nullif(count(v), 0) AS view_to_cart,
  CAST(count(a) AS DOUBLE) / nullif(count(c), 0) AS cart_to_abandon
FROM a)"""
    page = dict(statements)
    page["stream_clean_events"] = f"SELECT {columns} FROM fact_events_log"
    page["stream_events_by_day"] = """SELECT CAST("timestamp" AS DATE) AS day, event_type,
  count(*) AS cnt FROM fact_events_log GROUP BY ALL"""
    page["stream_deduplicated"] = page["stream_clean_events"]
    page["new_events"] = f"""SELECT {columns} FROM fact_events_log WHERE "timestamp" >= (SELECT
  coalesce(max("timestamp"), TIMESTAMP '0001-01-01') FROM fact_events_log WHERE NOT {since})"""
    page["load_rejects"] = "SELECT * FROM fact_orders WHERE order_status IS NULL"
    page["customer_360_upsert"] = """SELECT c.* REPLACE (CASE WHEN c.total_orders_completed > 0
  THEN v.loyalty_tier ELSE c.loyalty_tier END AS loyalty_tier)
FROM customer_360 c LEFT JOIN dim_users_validated v ON c.user_id = v.user_id"""
    page["merge_by_key"] = page["customer_360_upsert"]
    page["daily_refresh"] = "SELECT * FROM customer_360"
    return page


def _quality() -> dict[str, str]:
    words = {
        "Bronze": "('Bronze','Silver','Gold','Platinum')",
        "status": "('Pending','Processing','Completed','Cancelled')",
        "payment": "('Credit Card','Bank Slip','Voucher','Debit Card')",
        "event": "('view_item','add_to_cart','cart_abandonment')",
        "issue": "('Product Issue','General Inquiry','Positive Feedback')",
    }

    def rows(checks: list[tuple[str, str, str]], label: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{rule}' AS {label}, "
            f"count(*) FILTER ({bad}) AS violations FROM {table}"
            for table, rule, bad in checks
        )

    required = [(t, c, f'"{c}" IS NULL') for t, spec in TABLES.items() for c in spec.required]
    contract = [(t, f"{c} required", bad) for t, c, bad in required]
    for table, column, allowed, nullable in (
        ("dim_users", "loyalty_tier", words["Bronze"], True),
        ("fact_orders", "order_status", words["status"], False),
        ("fact_orders", "payment_method", words["payment"], True),
        ("fact_events_log", "event_type", words["event"], False),
        ("fact_cs_tickets", "issue_category", words["issue"], True),
        ("customer_360", "loyalty_tier", words["Bronze"], True),
    ):
        bad = f"{column} NOT IN {allowed}" + ("" if nullable else f" OR {column} IS NULL")
        contract.append((table, f"{column} in vocabulary", bad))
    for table, columns in (
        ("dim_products", ["cost_price"]),
        ("fact_orders", ["total_amount"]),
        ("fact_order_items", ["quantity", "unit_price"]),
        ("fact_events_log", ["time_spent_seconds"]),
        ("customer_360", ["total_lifetime_value", "total_orders_completed",
                          "total_abandoned_carts", "total_cs_complaints"]),
    ):
        contract += [(table, f"{c} at least 0", f"{c} < 0") for c in columns]
    dq = [
        ("dim_users", "user_id not null", "user_id IS NULL"),
        ("dim_users", "loyalty_tier known or null", f"loyalty_tier NOT IN {words['Bronze']}"),
        ("fact_orders", "order_status known",
         f"order_status IS NULL OR order_status NOT IN {words['status']}"),
        ("fact_orders", "total_amount not negative", "total_amount < 0"),
        ("fact_events_log", "event_type known",
         f"event_type IS NULL OR event_type NOT IN {words['event']}"),
        ("fact_cs_tickets", "rating within 1 to 5", "rating < 1 OR rating > 5"),
        ("fact_cs_tickets", "issue_category known or null",
         f"issue_category NOT IN {words['issue']}"),
    ]
    return {
        "not_null_violations": rows(required, "column_name"),
        "contract_report": rows(contract, "rule"),
        "dq_report": rows(dq, "rule"),
        "email_quality": r"""SELECT CASE
  WHEN "Customer_Email" IS NULL OR trim("Customer_Email") = '' THEN 'missing'
  WHEN strpos("Customer_Email", '@') = 0 THEN 'no_at'
  WHEN lower(split_part(trim("Customer_Email"), '@', -1))
    IN ('gmal.com','hotmal.com','outlok.com','yaho.com.br') THEN 'typo_domain'
  WHEN strpos(split_part(trim("Customer_Email"), '@', -1), '.') = 0 THEN 'no_dot'
  WHEN NOT regexp_matches("Customer_Email",
    '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$') THEN 'malformed'
  ELSE 'ok' END AS email_class, count(*) AS cnt FROM raw_tickets GROUP BY 1""",
        "distinct_ids": """SELECT DISTINCT trim(user_id) AS id FROM raw_orders
WHERE trim(user_id) <> ''""",
        "order_value_profile": f"""SELECT
  quantile_disc(total_amount, 0.5) AS median_value,
  quantile_disc(total_amount, 0.75) AS p75_value,
  quantile_disc(total_amount, 0.95) AS p95_value,
  CAST({MEAN} AS DECIMAL(18,2)) AS mean_value,
  (SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) FROM fact_order_items)
    AS items_per_order
FROM fact_orders""",
    }


def _staging() -> dict[str, str]:
    names = pseudonym_columns("user_id")
    return {
        "stg_customers": """SELECT customer_unique_id, customer_id, customer_city, customer_state
FROM mk_customers QUALIFY row_number() OVER (PARTITION BY customer_unique_id
  ORDER BY file_row) = 1""",
        "stg_first_order": """SELECT user_id,
  min(TRY_CAST(replace(order_purchase_timestamp, 'Z', '') AS TIMESTAMP)) AS first_order_at
FROM owned_orders WHERE known_customer GROUP BY user_id""",
        "stg_order_total": """SELECT order_id, paid AS total_amount
FROM mk_orders LEFT JOIN paid USING (order_id)""",
        "stg_primary_payment": """SELECT order_id, coalesce(method, 'Credit Card')
  AS payment_method FROM mk_orders LEFT JOIN first_payment USING (order_id)""",
        "stg_status": """SELECT order_id, CASE WHEN order_status = 'delivered' THEN 'Completed'
  WHEN order_status IN ('approved','processing','invoiced','shipped') THEN 'Processing'
  WHEN order_status IN ('canceled','unavailable') THEN 'Cancelled'
  ELSE 'Pending' END AS order_status FROM mk_orders""",
        "stg_orders": """SELECT order_id, user_id, paid AS total_amount,
  CASE WHEN order_status = 'delivered' THEN 'Completed'
  WHEN order_status IN ('approved','processing','invoiced','shipped') THEN 'Processing'
  WHEN order_status IN ('canceled','unavailable') THEN 'Cancelled'
  ELSE 'Pending' END AS order_status, coalesce(method, 'Credit Card') AS payment_method, created_at
FROM owned_orders LEFT JOIN paid USING (order_id) LEFT JOIN first_payment USING (order_id)
LEFT JOIN shifted USING (order_id)""",
        "stg_order_items": """SELECT order_id || '_' || order_item_id AS item_id, order_id,
  product_id, CAST(1 AS SMALLINT) AS quantity,
  coalesce(TRY_CAST(price AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS unit_price
FROM mk_items""",
        "stg_loyalty_exact": """SELECT user_id,
  CAST(total_spend AS DECIMAL(38,2)) AS total_spend,
  CASE WHEN total_spend IS NULL OR total_spend <= 0 THEN NULL
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.95 AS DOUBLE))) THEN 'Platinum'
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.85 AS DOUBLE))) THEN 'Gold'
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.65 AS DOUBLE))) THEN 'Silver'
    ELSE 'Bronze' END AS loyalty_tier
FROM (SELECT DISTINCT customer_unique_id AS user_id FROM mk_customers)
LEFT JOIN payments_per_user USING (user_id)""",
        "stg_product_name": "SELECT product_id, product_name, category FROM staged_products",
        "stg_products": """SELECT product_id, product_name, category,
  coalesce(cost_price, CAST(0 AS DECIMAL(10,2))) AS cost_price
FROM staged_products LEFT JOIN (SELECT product_id, CAST(CAST((14 * CAST(sum(p) * 100 AS HUGEINT)
    + 10 * count(p)) // (20 * count(p)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS cost_price
  FROM (SELECT product_id, coalesce(TRY_CAST(price AS DECIMAL(12,2)), 0) AS p FROM mk_items)
  GROUP BY product_id) USING (product_id)""",
        "stg_users": f"""SELECT user_id, {', '.join(f'{e} AS {n}' for n, e in names.items())},
  customer_city, customer_state, loyalty_tier,
  strftime(coalesce(first_order_at, TIMESTAMP '2017-01-01' + to_days(CAST(
    CAST('0x' || left(md5(user_id), 8) AS BIGINT) % 540 AS INTEGER)))
    + INTERVAL {{days}} DAY + INTERVAL {{seconds}} SECOND, '%Y-%m-%d %H:%M:%S') AS created_at
FROM (SELECT customer_unique_id AS user_id, arg_min(customer_city, file_row) AS customer_city,
    arg_min(customer_state, file_row) AS customer_state FROM mk_customers GROUP BY 1)
LEFT JOIN (SELECT user_id, min(TRY_CAST(replace(order_purchase_timestamp, 'Z', '') AS TIMESTAMP))
    AS first_order_at FROM owned_orders WHERE known_customer GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, CASE WHEN total_spend <= 0 THEN NULL
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.95 AS DOUBLE))) THEN 'Platinum'
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.85 AS DOUBLE))) THEN 'Gold'
    WHEN total_spend >= (SELECT total_spend FROM spend_ranks
      WHERE idx = floor(n * CAST(0.65 AS DOUBLE))) THEN 'Silver'
    ELSE 'Bronze' END AS loyalty_tier FROM payments_per_user) USING (user_id)""",
        "stg_tickets": f"""SELECT review_id AS "Ticket_ID", order_id AS "Order_ID",
  CASE WHEN user_id IS NOT NULL THEN {names['email']} END AS "Customer_Email",
  CASE WHEN rating <= 2 THEN 'Product Issue' WHEN rating = 3 THEN 'General Inquiry'
    ELSE 'Positive Feedback' END AS "Issue_Type",
  CASE WHEN trim(review_answer_timestamp) <> '' THEN 'Resolved' ELSE 'Open' END AS "Status",
  rating AS "Customer_Rating",
  CASE WHEN length(reported) = 10 THEN strftime(CAST(reported AS TIMESTAMP) + INTERVAL {{days}} DAY
      + INTERVAL {{seconds}} SECOND, '%Y-%m-%d')
    ELSE strftime(CAST(reported AS TIMESTAMP) + INTERVAL {{days}} DAY
      + INTERVAL {{seconds}} SECOND, '%Y-%m-%d %H:%M:%S') END AS "Reported_Date"
FROM (SELECT *, greatest(1, least(5, coalesce(TRY_CAST(review_score AS INTEGER), 3))) AS rating,
    coalesce(nullif(trim(review_creation_date), ''), nullif(trim(review_answer_timestamp), '')) AS reported
  FROM mk_reviews) LEFT JOIN owned_orders USING (order_id)""",
        "stg_shift_dates": "SELECT order_id, created_at FROM shifted",
        "pseudonymise": f"""SELECT user_id, {', '.join(f'{e} AS {n}' for n, e in names.items())}
FROM (SELECT DISTINCT customer_unique_id AS user_id FROM mk_customers)""",
        "stg_ticket_status": """SELECT review_id AS ticket_id,
  CASE WHEN trim(review_answer_timestamp) <> '' THEN 'Resolved' ELSE 'Open' END AS status
FROM mk_reviews""",
        "stg_rating": """SELECT ticket_id, rating, CASE WHEN rating <= 2 THEN 'Product Issue'
  WHEN rating = 3 THEN 'General Inquiry' ELSE 'Positive Feedback' END AS issue_type
FROM (SELECT review_id AS ticket_id,
  greatest(1, least(5, coalesce(TRY_CAST(review_score AS INTEGER), 3))) AS rating
  FROM mk_reviews)""",
        "ticket_contact": f"""SELECT review_id AS ticket_id, user_id,
  CASE WHEN user_id IS NOT NULL THEN {names['email']} END AS email
FROM mk_reviews LEFT JOIN owned_orders USING (order_id)""",
    }


def oracle_statements() -> dict[str, str]:
    clean = clean_prefix()
    shift: dt.timedelta = P.SHIFT_ANCHOR - HISTORY_END
    market = market_prefix(shift.days, shift.seconds)
    over_clean = {**_clean_layer(), **_serving(), **_feeds(), **_quality()}
    return {
        **{key: clean + sql for key, sql in over_clean.items()},
        **{
            key: market + sql.replace("{days}", str(shift.days)).replace("{seconds}", str(shift.seconds))
            for key, sql in _staging().items()
        },
    }
