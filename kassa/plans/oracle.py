"""Independent DuckDB SQL for each registered query.

The driver registers its parquet tables as DuckDB views (``customer``,
``orders``, ``lineitem``, ``part``, ``events`` ...).  Each oracle first maps
them to the shop model with the CTEs below (the same mapping as
:mod:`kassa.sources.adapter`, written independently in SQL), then states the
report in plain SQL.

Rules shared by all oracles:
  * Jakarta has a fixed +07:00 offset over the data's years, so a local time
    is ``ts + INTERVAL 7 HOUR``.
  * DuckDB turns decimal division into DOUBLE, so every rounded ratio is
    computed with :func:`rdiv` on exact integers (half away from zero, like
    PostgreSQL's numeric ROUND and Spark's decimal ROUND).
  * Dates are returned as ISO text, integers as BIGINT, money as DOUBLE.
"""

from __future__ import annotations

import datetime as dt

JAKARTA = "INTERVAL 7 HOUR"

MODEL_CTES = """
shop_customers AS (
  SELECT c_custkey AS id,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_name AS name,
         CASE WHEN c_nationkey = 0 THEN NULL
              ELSE chr(CAST(65 + (c_nationkey // 26) % 26 AS INTEGER)) || chr(CAST(65 + c_nationkey % 26 AS INTEGER))
         END AS country,
         CAST(DATE '1994-01-01' + CAST((c_custkey * 7919) % 730 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM customer
),
shop_category_rows AS (
  SELECT 0 AS kind, p_type AS name, p_type FROM (SELECT DISTINCT p_type FROM part)
  UNION ALL
  SELECT 1 AS kind, p_type || ' ' || p_brand AS name, p_type FROM (SELECT DISTINCT p_type, p_brand FROM part)
),
shop_categories AS (
  SELECT CAST('0x' || substr(md5(CASE kind WHEN 0 THEN 'p:' ELSE 'c:' END || name), 1, 15) AS BIGINT) AS id,
         name,
         CASE WHEN kind = 1 THEN CAST('0x' || substr(md5('p:' || p_type), 1, 15) AS BIGINT) END AS parent_id
  FROM shop_category_rows
),
shop_products AS (
  SELECT p.p_partkey AS id,
         p.p_name AS name,
         CASE WHEN p.p_partkey % 50 = 0 THEN NULL ELSE c.id END AS category_id,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST((p.p_partkey * 37) % 31 AS INTEGER) AS stock_quantity,
         p.p_partkey % 20 <> 0 AS is_active,
         CAST(DATE '1994-01-01' + CAST(p.p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM part p
  LEFT JOIN shop_categories c ON c.parent_id IS NOT NULL AND c.name = p.p_type || ' ' || p.p_brand
),
shop_orders AS (
  SELECT o_orderkey AS id,
         o_custkey AS customer_id,
         o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) AS updated_at
  FROM orders
),
shop_items AS (
  SELECT l_orderkey * 100 + l_linenumber AS id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS INTEGER) AS DECIMAL(12,0)) * 0.01
              AS DECIMAL(10,2)) AS unit_price
  FROM lineitem
),
shop_event_orders AS (
  SELECT event_id AS id, user_id AS customer_id, ts AS order_date, 'completed' AS status,
         CAST(value AS DECIMAL(12,2)) AS total_amount, ts AS updated_at
  FROM events
  WHERE event_type = 'purchase'
),
shop_rollup AS (
  SELECT c.id AS category_id, c.name AS category, COALESCE(p.name, c.name) AS parent_category
  FROM shop_categories c LEFT JOIN shop_categories p ON p.id = c.parent_id
),
shop_product_categories AS (
  SELECT pr.id AS product_id, pr.name AS product_name, pr.category_id, pr.stock_quantity,
         COALESCE(r.category, 'Uncategorized') AS category,
         COALESCE(r.parent_category, 'Uncategorized') AS parent_category
  FROM shop_products pr LEFT JOIN shop_rollup r ON r.category_id = pr.category_id
)"""


def with_model(body: str) -> str:
    """``WITH <model ctes>, <body>``; body starts with more CTEs or is a SELECT."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {MODEL_CTES}\n{body}"
    return f"WITH {MODEL_CTES},\n{body}"


def cents(x: str) -> str:
    """Exact integer cents of a two-decimal value."""
    return f"CAST(({x}) * 100 AS HUGEINT)"


def rdiv(num: str, den: str, scale: int = 2) -> str:
    """round_half_away_from_zero(num / den, scale) as DOUBLE; NULL if den = 0.

    ``num`` and ``den`` must be exact integer expressions.
    """
    p = 10**scale
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST(sign({n}) * sign({d}) * ((abs({n}) * {2 * p} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {p} END)"
    )


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def day(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"


def local_midnight(value: dt.date) -> str:
    """The instant at which a Jakarta day begins, in UTC."""
    return ts(dt.datetime(value.year, value.month, value.day) - dt.timedelta(hours=7))


def local_date(col: str) -> str:
    return f"CAST({col} + {JAKARTA} AS DATE)"


def local_month(col: str) -> str:
    return f"CAST(date_trunc('month', {col} + {JAKARTA}) AS DATE)"


def iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"
