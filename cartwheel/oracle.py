"""DuckDB SQL for every named query, written the plain way: the row-level
star join first, then one GROUP BY. The Spark plans pre-aggregate and
reorder; these check that the rewrite changes nothing.

Views available to the SQL: the driver's test tables (``region nation
customer part orders lineitem documents ...``).
"""

from __future__ import annotations

from cartwheel.config import ALL_JOBS_STATUS, EMAIL_PATTERN, SAVED_STATUS
from cartwheel.config import TESTDATA_PARAMS as P
from cartwheel.plans import etl

BINDING = """
WITH shop_customers AS (
    SELECT c.c_custkey AS customer_id, c.c_name AS first_name,
           c.c_mktsegment AS last_name, r.r_name AS region
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey),
shop_products AS (
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
    FROM part),
shop_orders AS (
    SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
           CAST(l.l_quantity AS INTEGER) AS quantity, CAST(o.o_orderdate AS DATE) AS order_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
order_details AS (
    SELECT o.order_id, c.customer_id AS cust_id, c.first_name, c.region, p.product_name,
           p.category, o.quantity, o.quantity * p.unit_price AS order_total, o.order_date
    FROM shop_orders o
    JOIN shop_customers c ON o.customer_id = c.customer_id
    JOIN shop_products p ON o.product_id = p.product_id),
customer_spend AS (
    SELECT o.customer_id, SUM(o.quantity * p.unit_price) AS total_spend
    FROM shop_orders o JOIN shop_products p ON o.product_id = p.product_id
    GROUP BY o.customer_id),
open_orders AS (
    SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS since, max(CAST(l.l_shipdate AS DATE)) AS until
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY ALL),
customer_tiers AS (
    SELECT c.first_name, c.last_name, c.region, s.total_spend,
           {spend_tier} AS discount_tier
    FROM customer_spend s JOIN shop_customers c ON s.customer_id = c.customer_id)
"""

RATE_CASE = ("CASE discount_tier " + " ".join(
    f"WHEN '{tier}' THEN CAST({rate!r} AS DOUBLE)" for tier, rate in P.discount_rates.items())
    + " ELSE CAST(0.0 AS DOUBLE) END")


# the rules at the test tables' thresholds, spelled out independently of the
# engine's rule tables
def _spend_tier(x: str) -> str:
    return (f"CASE WHEN {x} >= 1200000 THEN 'Platinum' WHEN {x} >= 950000 THEN 'Gold' "
            f"WHEN {x} >= 720000 THEN 'Silver' ELSE 'Bronze' END")


def _price_tier(x: str) -> str:
    return f"CASE WHEN {x} > 975 THEN 'Premium' WHEN {x} > 925 THEN 'Standard' ELSE 'Budget' END"


def _revenue_tier(x: str) -> str:
    return f"CASE WHEN {x} > 3800000 THEN 'High' WHEN {x} > 3300000 THEN 'Medium' ELSE 'Low' END"


def _with(body: str) -> str:
    return BINDING.format(spend_tier=_spend_tier("s.total_spend")) + body


def _summary(with_unique: bool) -> str:
    unique = ", COUNT(DISTINCT cust_id) AS unique_customers" if with_unique else ""
    return f"""
SELECT region, month, CAST(total AS DOUBLE) AS total_revenue, order_count,
       CAST(total AS DOUBLE) / n_totals AS avg_order_value{', unique_customers' if with_unique else ''},
       {_revenue_tier('total')} AS revenue_tier
FROM (SELECT region, CAST(date_trunc('month', order_date) AS DATE) AS month,
             SUM(order_total) AS total, COUNT(order_id) AS order_count,
             COUNT(order_total) AS n_totals{unique}
      FROM order_details GROUP BY 1, 2)"""


CUSTOMER_360 = f"""
SELECT c.customer_id, c.first_name, c.last_name, c.region,
       CAST(m.total_spend AS DOUBLE) AS total_spend, m.order_count,
       CAST(m.total_spend AS DOUBLE) / m.n_totals AS avg_order_value,
       {_spend_tier('m.total_spend')} AS discount_tier
FROM shop_customers c
JOIN (SELECT o.customer_id, SUM(o.quantity * p.unit_price) AS total_spend,
             COUNT(o.order_id) AS order_count, COUNT(o.quantity * p.unit_price) AS n_totals
      FROM shop_orders o JOIN shop_products p ON o.product_id = p.product_id
      GROUP BY o.customer_id) m ON c.customer_id = m.customer_id"""

ROW_COUNTS = """
SELECT 'CUSTOMERS' AS table_name, COUNT(*) AS row_count FROM shop_customers
UNION ALL SELECT 'PRODUCTS', COUNT(*) FROM shop_products
UNION ALL SELECT 'ORDERS', COUNT(*) FROM shop_orders"""


def _status(body: str, table: str) -> str:
    """SQL for SAVED_STATUS with the row count of ``body``."""
    head, tail = SAVED_STATUS.format(rows="\0", table=table).split("\0")
    return f"'{head}' || CAST((SELECT COUNT(*) FROM ({body})) AS VARCHAR) || '{tail}'"


MONTHLY_TARGET = etl.target(P, etl.MONTHLY_SUMMARY)
C360_TARGET = etl.target(P, etl.CUSTOMER_360)


def _all_jobs_status() -> str:
    """SQL for ALL_JOBS_STATUS around the two saved-status lines."""
    head, mid, tail = ALL_JOBS_STATUS.format(first="\0", second="\0").split("\0")
    first, second = _status(_summary(True), MONTHLY_TARGET), _status(CUSTOMER_360, C360_TARGET)
    return f"SELECT '{head}' || {first} || '{mid}' || {second} || '{tail}' AS status"

SQL: dict[str, str] = {
    "table_row_counts": ROW_COUNTS,
    "customer_names": "SELECT first_name, last_name, region FROM shop_customers",
    "price_with_tax": f"""
SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(unit_price AS DOUBLE) * CAST({P.tax_factor!r} AS DOUBLE) AS price_with_tax
FROM shop_products""",
    "customers_in_region": f"""
SELECT customer_id, first_name, last_name, region FROM shop_customers
WHERE region = '{P.region}'""",
    "expensive_in_category": f"""
SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price FROM shop_products
WHERE category = '{P.category}' AND unit_price > {P.min_price!r}""",
    "price_tier": f"""
SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price,
       {_price_tier('unit_price')} AS price_tier
FROM shop_products""",
    "order_details": """
SELECT order_id, first_name, region, product_name, category, quantity,
       CAST(order_total AS DOUBLE) AS order_total, order_date
FROM order_details""",
    "revenue_by_region": """
SELECT region, CAST(SUM(order_total) AS DOUBLE) AS total_revenue, COUNT(order_id) AS order_count,
       CAST(SUM(order_total) AS DOUBLE) / COUNT(order_total) AS avg_order_value
FROM order_details GROUP BY region ORDER BY SUM(order_total) DESC""",
    "monthly_revenue": """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       CAST(SUM(order_total) AS DOUBLE) AS revenue,
       COUNT(DISTINCT first_name) AS unique_customers
FROM order_details GROUP BY 1 ORDER BY 1""",
    "top_products": f"""
SELECT product_name, CAST(SUM(order_total) AS DOUBLE) AS total_revenue
FROM order_details GROUP BY product_name
ORDER BY SUM(order_total) DESC, product_name LIMIT {P.top_products}""",
    "category_revenue_by_region": f"""
SELECT upper(region) AS region, CAST(SUM(order_total) AS DOUBLE) AS revenue,
       COUNT(order_id) AS num_orders
FROM order_details WHERE category = '{P.category}'
GROUP BY upper(region) HAVING SUM(order_total) > {P.min_category_revenue!r}
ORDER BY SUM(order_total) DESC""",
    "customer_spend": """
SELECT customer_id, CAST(total_spend AS DOUBLE) AS total_spend FROM customer_spend""",
    "customer_tiers": """
SELECT first_name, last_name, region, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier
FROM customer_tiers ORDER BY total_spend DESC""",
    "tier_summary": """
SELECT discount_tier, CAST(SUM(total_spend) AS DOUBLE) AS tier_total_spend
FROM customer_tiers GROUP BY discount_tier""",
    "tier_counts": """
SELECT discount_tier, COUNT(*) AS "count" FROM customer_tiers GROUP BY discount_tier""",
    "email_domain": f"""
SELECT doc_id, email,
       CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) ELSE 'unknown' END AS domain
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_PATTERN}')) AS email FROM documents)""",
    "customer_discounts": f"""
SELECT first_name, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier,
       CAST(total_spend AS DOUBLE) * ({RATE_CASE}) AS discount_amount
FROM customer_tiers""",
    "monthly_revenue_summary": _summary(True),
    "monthly_revenue_summary_basic": _summary(False),
    "customer_360": CUSTOMER_360,
    "monthly_summary_sample": f"""
SELECT * FROM ({_summary(True)}) ORDER BY month, region LIMIT {P.sample_rows}""",
    "top_spenders": f"""
SELECT * FROM ({CUSTOMER_360}) ORDER BY total_spend DESC, customer_id LIMIT {P.sample_rows}""",
    "tier_lookup_sql": """
SELECT first_name AS name, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier
FROM customer_tiers""",
    "call_registered_job": f"SELECT {_status(_summary(True), MONTHLY_TARGET)} AS status",
    "run_all_jobs": _all_jobs_status(),
    "load_raw_tables": ROW_COUNTS,
    "raw_customers": """
SELECT customer_id, first_name, last_name, CAST(NULL AS VARCHAR) AS email, region, CAST(NULL AS DATE) AS signup_date
FROM shop_customers""",
    "raw_products": """
SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price FROM shop_products""",
    "raw_orders": "SELECT order_id, customer_id, product_id, quantity, order_date FROM shop_orders",
    "run_all_monthly_summary": _summary(True),
    "run_all_customer_360": CUSTOMER_360,
    "tier_lookup_python_sql": f"""
SELECT first_name AS name, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier,
       CAST(total_spend AS DOUBLE) * ({RATE_CASE}) AS discount_amount
FROM customer_tiers""",
}
SQL |= {
    "distinct_products_sketch": f"""
SELECT CASE grouping(region) * 2 + grouping(month) WHEN 0 THEN 'region_month' WHEN 1 THEN 'region' WHEN 2 THEN 'month' ELSE 'all' END AS level,
       region, month, count(DISTINCT product_id) AS exact_products,
       greatest(CAST(1.0 AS DOUBLE), CAST(count(DISTINCT product_id) AS DOUBLE) * CAST(0.065 AS DOUBLE)) AS error_bound, TRUE AS within_bound
FROM (SELECT c.region, CAST(date_trunc('month', o.order_date) AS DATE) AS month, o.product_id
      FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id)
GROUP BY CUBE (region, month)""",
    "incremental_monthly_summary": _summary(True),
    "streamed_event_windows": """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    "event_sessions": """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM (
          SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
          FROM events WHERE ts IS NOT NULL))
GROUP BY user_id, session""",
    "events_last_order": """
SELECT e.event_id, e.user_id, e.at, o.last_order, o.orders_that_day, o.last_order_id
FROM (SELECT event_id, user_id, ts - INTERVAL 9131 DAY AS at FROM events) e
ASOF LEFT JOIN (SELECT o_custkey AS user_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS last_order, count(*) AS orders_that_day,
                       max(o_orderkey) AS last_order_id FROM orders GROUP BY 1, 2) o
ON e.user_id = o.user_id AND e.at >= o.last_order""",
    "overlapping_orders": """
SELECT a.customer_id, a.order_id AS order_a, b.order_id AS order_b,
       CAST(date_diff('day', greatest(a.since, b.since), least(a.until, b.until)) + 1 AS INTEGER) AS overlap_days
FROM open_orders a JOIN open_orders b ON a.customer_id = b.customer_id AND a.order_id < b.order_id AND a.since <= b.until AND b.since <= a.until
WHERE a.since <= a.until AND b.since <= b.until""",
    "spend_percentiles": """
SELECT c.region, count(*) AS customers, CAST(quantile_disc(s.total_spend, 0.5) AS DOUBLE) AS median_spend,
       CAST(quantile_disc(s.total_spend, 0.9) AS DOUBLE) AS p90_spend, CAST(quantile_disc(s.total_spend, 0.99) AS DOUBLE) AS p99_spend
FROM customer_spend s JOIN shop_customers c ON s.customer_id = c.customer_id GROUP BY c.region""",
    "revenue_cube": """
SELECT region, category, month, CAST(grouping(region) * 4 + grouping(category) * 2 + grouping(month) AS BIGINT) AS grouping_id,
       CAST(sum(order_total) AS DOUBLE) AS revenue, count(*) AS n_lines, count(DISTINCT cust_id) AS customers
FROM (SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS month FROM order_details) GROUP BY CUBE (region, category, month)""",
    "heavy_products": """
SELECT p.p_partkey AS product_id, p.p_name AS product_name, h.n AS n_lines, h.total AS total_lines
FROM (SELECT l_partkey, count(*) AS n, (SELECT count(*) FROM lineitem) AS total FROM lineitem GROUP BY l_partkey) h
JOIN part p ON p.p_partkey = h.l_partkey WHERE h.n > CAST(0.0007 AS DOUBLE) * h.total""",
    "upserted_customer_360": CUSTOMER_360,
    "customer_360_dates": f"""
SELECT x.*, d.first_order_date, d.last_order_date FROM ({CUSTOMER_360}) x JOIN (
    SELECT o.customer_id, min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date
    FROM shop_orders o JOIN shop_products p ON o.product_id = p.product_id GROUP BY o.customer_id) d ON x.customer_id = d.customer_id""",
    "discounts_from_literal_rows": f"""
SELECT customer_id, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier, CAST(total_spend AS DOUBLE) * ({RATE_CASE}) AS discount_amount
FROM (SELECT *, {_spend_tier('total_spend')} AS discount_tier FROM customer_spend)""",
}
SQL["customer_tiers_udf"] = SQL["customer_tiers_arrow_udf"] = SQL["customer_tiers"]
SQL["email_domain_udf"] = SQL["email_domain"]
SQL["customer_discounts_native"] = SQL["customer_discounts_udf"] = SQL["customer_discounts"]


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in SQL.items()}
