"""DuckDB oracle SQL per registered key (see :mod:`kassa.plans.oracle`).

Each oracle states the rule of its report from the report's definition, in a
shape of its own: point-in-time subqueries, lists per customer and lookup
tables instead of windows.  Expected titles, keys, aliases and instants are
written out here; nothing is taken from the operators under test.
"""

from __future__ import annotations

import datetime as dt

from kassa.plans import catalog as C
from kassa.plans.oracle import cents, day, iso, local_date, local_midnight, local_month, rdiv, with_model

ORACLES: dict[str, str] = {}


def _trend(orders_cte: str, days: int, as_of: dt.date) -> str:
    """Each reported day looks back over its own seven days."""
    return with_model(f"""
sale AS MATERIALIZED (
  SELECT {local_date('order_date')} AS sold_on, {cents('total_amount')} AS c FROM {orders_cte} WHERE status = 'completed'
),
reported AS (
  SELECT CAST({day(as_of)} - CAST(back AS INTEGER) AS DATE) AS d FROM range(1, {days + 1}) AS r(back)
),
seen AS (
  SELECT d,
         count(c) FILTER (WHERE sold_on = d) AS n1, COALESCE(sum(c) FILTER (WHERE sold_on = d), 0) AS c1,
         count(c) AS n7, COALESCE(sum(c), 0) AS c7
  FROM reported LEFT JOIN sale ON sold_on BETWEEN d - 6 AND d
  GROUP BY d
)
SELECT {iso('d')} AS day,
       ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][dayofweek(d) + 1] AS day_of_week,
       n1 AS total_orders,
       CAST(c1 AS DOUBLE) / 100 AS revenue,
       {rdiv('c7', '700')} AS revenue_7d_avg,
       {rdiv('n7', '7')} AS orders_7d_avg,
       {rdiv('(7 * c1 - c7) * 100', 'c7')} AS revenue_vs_avg_pct,
       -- more than 30 % away from the average of the seven days
       CASE WHEN c7 > 0 AND 70 * c1 > 13 * c7 THEN 'Spike' WHEN c7 > 0 AND 70 * c1 < 7 * c7 THEN 'Drop' ELSE 'Normal' END AS anomaly_flag
FROM seen
""")


def _daily(orders_cte: str, first: dt.date, end: dt.date) -> str:
    return with_model(f"""
SELECT strftime(sold_on, '%Y-%m-%d') AS day, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM (SELECT {local_date('order_date')} AS sold_on, total_amount FROM {orders_cte} WHERE status = 'completed')
WHERE sold_on >= {day(first)} AND sold_on < {day(end)}
GROUP BY sold_on
""")


ORACLES["sales_trend"] = _trend("shop_orders", C.DAYS, C.AS_OF)
ORACLES["sales_trend_events"] = _trend("shop_event_orders", 30, C.EVENTS_AS_OF)
ORACLES["weekly_sales"] = _trend("shop_orders", 7, C.AS_OF)
ORACLES["daily_sales"] = _daily("shop_orders", dt.date(2000, 8, 2), C.AS_OF)
ORACLES["daily_sales_events"] = _daily("shop_event_orders", dt.date(2024, 1, 1), C.EVENTS_AS_OF)


def _report(ctes: str, select: str, where: str | None = None) -> str:
    if where is None:
        return with_model(f"{ctes},\n{select}" if ctes else select)
    return with_model(f"{ctes + ',' if ctes else ''}\nreport AS ({select})\nSELECT * FROM report WHERE {where}")


# What each product sold, by the Jakarta month of the order; the report day is
# 2001-08-02, so its last month is 2001-07 and the one before 2001-06, and its
# 90 days begin on 2001-05-04.
_LAST_MONTH = "2001-07"
_SOLD = f"""
line AS (
  SELECT i.product_id, i.quantity AS q, i.quantity * i.unit_price AS money, o.order_date AS ordered,
         strftime(o.order_date + INTERVAL 7 HOUR, '%Y-%m') AS ym
  FROM shop_orders o, shop_items i WHERE i.order_id = o.id AND o.status = 'completed'
),
sold AS (
  SELECT product_id, sum(q) AS units, sum(money) AS revenue,
         sum(CASE ym WHEN '{_LAST_MONTH}' THEN money ELSE 0 END) AS july,
         sum(CASE ym WHEN '2001-06' THEN money ELSE 0 END) AS june,
         sum(CASE WHEN ordered >= {local_midnight(dt.date(2001, 5, 4))} THEN q ELSE 0 END) AS recent_units,
         max(ordered) AS last_at
  FROM line GROUP BY product_id
)"""


def _change_pct(new: str, old: str) -> str:
    return rdiv(f"({cents(new)} - {cents(old)}) * 100", cents(old))


# A product's rank is one more than the products of its category that earned more.
ORACLES["product_performance"] = _report(
    f"""{_SOLD},
earner AS (SELECT p.*, s.* EXCLUDE (product_id) FROM shop_product_categories p JOIN sold s USING (product_id)),
shelf AS (
  SELECT category_id AS shelf_id, count(*) AS products, sum(revenue) AS takings, list(revenue) AS takes
  FROM earner GROUP BY category_id
),
placed AS (
  SELECT e.*, products, takings, len(list_filter(takes, lambda x: x > e.revenue)) AS ahead
  FROM earner e JOIN shelf ON shelf_id IS NOT DISTINCT FROM category_id
)""",
    f"""
SELECT product_id, product_name, category, parent_category,
       CAST(revenue AS DOUBLE) AS total_revenue, CAST(units AS BIGINT) AS units_sold,
       CAST(ahead + 1 AS BIGINT) AS category_revenue_rank,
       {rdiv(cents('revenue') + ' * 100', cents('takings'))} AS category_revenue_share_pct,
       '{_LAST_MONTH}' AS last_month,
       CAST(july AS DOUBLE) AS last_month_revenue, CAST(june AS DOUBLE) AS prev_month_revenue,
       CAST(july - june AS DOUBLE) AS mom_revenue_change, {_change_pct('july', 'june')} AS mom_revenue_change_pct,
       products = 1 OR 5 * ahead < products - 1 AS is_top_20_pct_in_category
FROM placed""",
)

# Stock reaches for stock * 90 / units days; the first band that it stays within names it.
_INVENTORY = (
    f"""{_SOLD},
item AS (
  SELECT p.*, p.stock_quantity AS stock, COALESCE(s.recent_units, 0) AS u, s.last_at
  FROM shop_product_categories p LEFT JOIN sold s USING (product_id)
)""",
    f"""
SELECT product_id, product_name, category, CAST(stock AS BIGINT) AS stock_quantity,
       CAST(u AS BIGINT) AS units_sold_90d,
       {rdiv('u', '90')} AS daily_sales_rate,
       {rdiv('stock * 90', 'u', 1)} AS days_until_stockout,
       strftime(last_at + INTERVAL 7 HOUR, '%Y-%m-%d') AS last_order_date,
       CASE WHEN u = 0 THEN 'Dead Stock'
            ELSE ['Critical', 'Low', 'Adequate', 'Overstocked'][
              1 + CAST(stock * 90 >= 7 * u AS INT) + CAST(stock * 90 >= 30 * u AS INT) + CAST(stock * 90 > 90 * u AS INT)]
       END AS stock_status,
       -- half of the units sold in 90 days last 45 days
       CAST(greatest((u + 1) // 2 - stock, 0) AS BIGINT) AS reorder_quantity
FROM item WHERE NOT (stock <= 0 AND u <= 0)""",
)
ORACLES["inventory_turnover"] = _report(*_INVENTORY)
ORACLES["low_stock_alerts"] = _report(*_INVENTORY, "stock_status IN ('Critical', 'Low')")

_TODAY = f"o.status = 'completed' AND {local_date('o.order_date')} = {day(C.SUMMARY_DAY)}"
ORACLES["daily_sales_summary"] = _report(
    "",
    f"""
SELECT count(*) AS total_orders,
       CAST(CAST(COALESCE(sum(total_amount), 0) AS DECIMAL(38,2)) AS VARCHAR) AS total_revenue,
       printf('%.2f', COALESCE({rdiv(cents('COALESCE(sum(total_amount), 0)'), 'count(*) * 100')}, 0)) AS average_order_value,
       (SELECT min(category) FROM (
          SELECT p.parent_category AS category, sum(i.quantity * i.unit_price) AS money, max(money) OVER () AS most
          FROM shop_orders o JOIN shop_items i ON i.order_id = o.id JOIN shop_product_categories p USING (product_id)
          WHERE {_TODAY} GROUP BY p.parent_category) WHERE money = most) AS top_category
FROM shop_orders o WHERE {_TODAY}""",
)

# A customer joins in the first month with a completed order, and comes back if
# the next month has one too.
ORACLES["customer_cohort"] = _report(
    f"""
spent AS (
  SELECT customer_id, {local_month('order_date')} AS m, sum(total_amount) AS money
  FROM shop_orders WHERE status = 'completed' GROUP BY ALL
),
newcomer AS (
  SELECT s.m, s.money, CAST(s.m + INTERVAL 1 MONTH AS DATE) IN
           (SELECT n.m FROM spent n WHERE n.customer_id = s.customer_id) AS back
  FROM spent s
  WHERE year(s.m) = {C.YEAR} AND NOT EXISTS (SELECT 1 FROM spent e WHERE e.customer_id = s.customer_id AND e.m < s.m)
),
months AS (SELECT m, count(*) AS joined, sum(money) AS money, count(*) FILTER (WHERE back) AS back FROM newcomer GROUP BY m)""",
    f"""
SELECT strftime(a.m, '%Y-%m') AS cohort_month, a.joined AS new_customers,
       CAST(a.money AS DOUBLE) AS first_month_revenue,
       (SELECT count(*) FROM newcomer x WHERE x.m <= a.m) AS running_total_customers,
       a.back AS retained_customers,
       {rdiv('a.back * 100', 'a.joined')} AS retention_rate_pct,
       a.joined - (SELECT arg_max(b.joined, b.m) FROM months b WHERE b.m < a.m) AS new_customers_change
FROM months a""",
)

# The completed orders of each customer as one list, by time and id.
_HISTORY = """
history AS (
  SELECT customer_id AS who,
         list({'at': order_date, 'id': id, 'money': total_amount} ORDER BY order_date, id) AS orders
  FROM shop_orders WHERE status = 'completed' GROUP BY customer_id
)"""
ORACLES["order_sequence"] = _report(
    f"""{_HISTORY},
numbered AS (SELECT who, orders, len(orders) AS n, unnest(range(1, len(orders) + 1)) AS k FROM history)""",
    f"""
SELECT orders[k].id AS order_id, who AS customer_id, strftime(orders[k].at, '%Y-%m-%d %H:%M:%S') AS order_date,
       CAST(orders[k].money AS DOUBLE) AS total_amount,
       CASE WHEN k > 1 THEN {rdiv("epoch_us(orders[k].at) - epoch_us(orders[k - 1].at)", "86400000000", 6)} END AS days_since_prev,
       CAST(k AS BIGINT) AS order_no, CAST(n AS BIGINT) AS total_orders
FROM numbered""",
)

# The mean gap is the span over the number of gaps.
ORACLES["purchase_patterns"] = _report(
    f"""{_HISTORY},
buyer AS (
  SELECT who, orders, len(orders) AS n, epoch_us(orders[-1].at) - epoch_us(orders[1].at) AS span,
         list_transform(range(2, len(orders) + 1), lambda k: (epoch_us(orders[k].at) - epoch_us(orders[k - 1].at)) / 86400000000.0) AS gaps,
         list_sum(list_transform(orders, lambda o: {cents('o.money')})) AS spent,
         list_sum(list_transform(orders[1:3], lambda o: {cents('o.money')})) AS early,
         list_sum(list_transform(orders[-3:], lambda o: {cents('o.money')})) AS late
  FROM history
  WHERE len(orders) >= 3
    AND len(list_filter(orders, lambda o: year(o.at + INTERVAL 7 HOUR) = {C.YEAR})) > 0
),
bought AS (
  SELECT who, p.parent_category AS category, count(*) AS n
  FROM (SELECT who, unnest(orders).id AS order_id FROM buyer)
  JOIN shop_items USING (order_id) JOIN shop_product_categories p USING (product_id) GROUP BY ALL
),
favourite AS (
  SELECT who, array_to_string(list_sort(list(category)), ', ') AS names
  FROM bought b WHERE n = (SELECT max(x.n) FROM bought x WHERE x.who = b.who) GROUP BY who
)""",
    f"""
SELECT who AS customer_id, name, email, CAST(n AS BIGINT) AS total_orders,
       {rdiv('span', '(n - 1) * 86400000000', 1)} AS avg_days_between_orders,
       round(list_aggregate(gaps, 'stddev_samp'), 1) AS stddev_days_between_orders,
       names AS most_purchased_category,
       {rdiv('spent', 'n * 100')} AS avg_order_value,
       CASE WHEN late > early THEN 'Increasing' ELSE 'Decreasing' END AS spending_trend,
       CAST({local_date('orders[-1].at')} - {local_date('orders[1].at')} AS BIGINT) AS lifetime_days
FROM buyer JOIN shop_customers ON id = who LEFT JOIN favourite USING (who)""",
)

# Scores count the bounds that a customer meets; the quintile is the share of
# customers placed before, the first n % 5 quintiles holding one more.
_RFM = (
    f"""
buyer AS (
  SELECT customer_id, count(*) AS times, sum(total_amount) AS money, {day(C.AS_OF)} - max({local_date('order_date')}) AS days
  FROM shop_orders WHERE status = 'completed' AND customer_id IN (SELECT id FROM shop_customers) GROUP BY customer_id
),
ordered AS (
  SELECT unnest(list(customer_id ORDER BY money, customer_id)) AS customer_id, unnest(range(count(*))) AS place, count(*) AS n
  FROM buyer
),
scored AS (
  SELECT b.*,
         1 + len(list_filter([30, 90, 180, 365], lambda x: days <= x)) AS r,
         1 + len(list_filter([3, 6, 10, 20], lambda x: times >= x)) AS f,
         CASE WHEN place < (n % 5) * (n // 5 + 1) THEN 1 + place // (n // 5 + 1)
              ELSE 1 + n % 5 + (place - (n % 5) * (n // 5 + 1)) // (n // 5) END AS m
  FROM buyer b JOIN ordered USING (customer_id)
)""",
    """
SELECT customer_id, name, email, CAST(days AS BIGINT) AS recency_days, times AS frequency_count,
       CAST(money AS DOUBLE) AS monetary_value, r AS r_score, f AS f_score, CAST(m AS BIGINT) AS m_score,
       CAST(r + f + m AS BIGINT) AS rfm_score,
       ['Lost', 'At Risk', 'Loyal', 'Champions'][1 + len(list_filter([6, 9, 12], lambda x: r + f + m >= x))] AS segment
FROM scored JOIN shop_customers ON id = customer_id""",
)
ORACLES["rfm_segmentation"] = _report(*_RFM)
ORACLES["churn_risk"] = _report(*_RFM, "segment IN ('At Risk', 'Lost')")

ORACLES["monthly_revenue_breakdown"] = _report(
    _SOLD,
    f"""
SELECT parent_category, category, '{_LAST_MONTH}' AS last_month,
       CAST(sum(july) AS DOUBLE) AS last_month_revenue, CAST(sum(june) AS DOUBLE) AS prev_month_revenue,
       CAST(sum(july) - sum(june) AS DOUBLE) AS mom_revenue_change,
       {_change_pct('sum(july)', 'sum(june)')} AS mom_revenue_change_pct
FROM sold JOIN shop_product_categories USING (product_id) GROUP BY parent_category, category""",
)

ORACLES["category_rollup"] = _report(
    "", "SELECT CAST(category_id AS BIGINT) AS category_id, category, parent_category FROM shop_rollup"
)

ORACLES["category_tree"] = with_model("""
climb AS (
  SELECT id, id AS at_id, 0 AS depth FROM shop_categories
  UNION ALL
  SELECT c.id, p.parent_id, depth + 1 FROM climb c JOIN shop_categories p ON p.id = c.at_id WHERE p.parent_id IS NOT NULL
),
tops AS (SELECT id, arg_max(at_id, depth) AS top_id, max(depth) AS depth FROM climb GROUP BY id)
SELECT t.id AS category_id, c.name AS category, top_id, p.name AS top_level, CAST(depth AS BIGINT) AS depth, FALSE AS cyclic
FROM tops t JOIN shop_categories c ON c.id = t.id JOIN shop_categories p ON p.id = top_id
""").replace("WITH", "WITH RECURSIVE", 1)

ORACLES["product_sales"] = _report(
    _SOLD,
    """
SELECT product_id, CAST(units AS BIGINT) AS units_sold, CAST(revenue AS DOUBLE) AS revenue,
       CAST(july AS DOUBLE) AS last_month_revenue, CAST(june AS DOUBLE) AS prev_month_revenue,
       CAST(recent_units AS BIGINT) AS units_sold_window, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_order_at
FROM sold""",
)

ORACLES["customer_monthly_summary"] = _report(
    "",
    f"""
SELECT customer_id, {iso(local_month('order_date'))} AS order_month,
       COUNT(*) AS order_count, CAST(SUM(total_amount) AS DOUBLE) AS revenue
FROM shop_orders WHERE status = 'completed'
GROUP BY 1, 2""",
)


# ---- A: ad-hoc and lookups -------------------------------------------------
# C.SINCE is 1999-01-01 in Jakarta, 17:00 of the day before in UTC.
def _frequent(which: str) -> str:
    """Customers with six or more orders since then, from one list of amounts each."""
    return f"""
regular AS (
  SELECT c.id AS customer_id, c.name, c.email, len(amounts) AS order_count, CAST(list_sum(amounts) AS DOUBLE) AS total_revenue
  FROM shop_customers c, (
    SELECT customer_id, list(total_amount) AS amounts
    FROM shop_orders WHERE order_date >= TIMESTAMP '1998-12-31 17:00:00' AND {which} GROUP BY customer_id
  ) x
  WHERE x.customer_id = c.id AND len(amounts) >= 6
)"""


ORACLES["frequent_customers_join_first"] = _report(
    _frequent("true"), "SELECT name, email, order_count, total_revenue FROM regular"
)
ORACLES["frequent_customers_agg_first"] = ORACLES["frequent_customers_join_first"]
ORACLES["frequent_customers_top"] = _report(
    _frequent("status = 'completed'"),
    """
SELECT * FROM regular r
WHERE (SELECT count(*) FROM regular x
       WHERE x.total_revenue > r.total_revenue OR x.total_revenue = r.total_revenue AND x.customer_id < r.customer_id) < 100""",
)
# both forms give the same rows, so nothing is left
ORACLES["frequent_customers_diff"] = _report(
    _frequent("true"),
    "SELECT name, email, order_count, total_revenue, '' AS only_in FROM regular WHERE false",
)
_CUSTOMER_ROW = """SELECT id, email, name, COALESCE(country, '') AS country,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM shop_customers"""
ORACLES["customer_by_id"] = _report("", f"{_CUSTOMER_ROW} WHERE id = {C.LOOKUP_ID}")
ORACLES["customer_by_email"] = _report("", f"{_CUSTOMER_ROW} WHERE lower(email) = lower('{C.LOOKUP_EMAIL}')")

# ---- D: data quality ---------------------------------------------------------

# The shop with faults: which rows of the model are wrong, and how.
_FAULTS = """
bad_customers AS (
  SELECT id,
         CASE WHEN id % 97 = 3 THEN 'unknown'
              WHEN id % 101 = 5 THEN 'pair' || (id // 101) || '@example.com'
              WHEN id % 101 = 6 THEN 'Pair' || (id // 101) || '@Example.com' ELSE email END AS email,
         CASE WHEN id % 211 <> 0 THEN name END AS name,
         CASE WHEN id % 83 = 2 THEN lower(coalesce(country, 'xx')) || '1' ELSE country END AS country, created_at
  FROM shop_customers
),
bad_parents AS (
  SELECT id, name, CASE WHEN id % 7 = 0 AND parent_id IS NOT NULL THEN -1 ELSE parent_id END AS parent_id FROM shop_categories
),
bad_categories AS (SELECT * FROM bad_parents UNION ALL SELECT -id, name, parent_id FROM bad_parents WHERE id % 10 = 0),
bad_products AS (
  SELECT * REPLACE (
    CASE WHEN id % 61 = 0 THEN -price ELSE price END AS price,
    CASE WHEN id % 67 = 0 THEN -1 ELSE stock_quantity END AS stock_quantity,
    CASE WHEN id % 71 = 0 THEN -5 ELSE category_id END AS category_id,
    CASE WHEN id % 73 = 0 THEN NULL ELSE name END AS name)
  FROM shop_products
),
bad_orders AS (
  SELECT * REPLACE (
    CASE WHEN id % 53 = 0 THEN NULL WHEN id % 59 = 0 THEN 'Completed' ELSE status END AS status,
    CASE WHEN id % 103 = 0 THEN -total_amount ELSE total_amount END AS total_amount,
    CASE WHEN id % 107 = 0 THEN -customer_id ELSE customer_id END AS customer_id)
  FROM shop_orders
),
bad_items AS (
  SELECT * REPLACE (
    CASE WHEN id % 109 = 0 THEN 0 ELSE quantity END AS quantity,
    CASE WHEN id % 113 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
    CASE WHEN id % 127 = 0 THEN -order_id ELSE order_id END AS order_id,
    CASE WHEN id % 131 = 0 THEN -product_id ELSE product_id END AS product_id)
  FROM shop_items
)"""

# Columns that must not be null.
_REQUIRED = {
    "customers": ("id", "email", "name", "created_at"),
    "categories": ("id", "name"),
    "products": ("id", "name", "price", "stock_quantity", "is_active", "created_at"),
    "orders": ("id", "customer_id", "order_date", "status", "total_amount", "updated_at"),
    "order_items": ("id", "order_id", "product_id", "quantity", "unit_price"),
}
_MODEL_VIEW = {
    "customers": "shop_customers",
    "categories": "shop_categories",
    "products": "shop_products",
    "orders": "shop_orders",
    "order_items": "shop_items",
}
ORACLES["dq_nulls"] = _report(
    _FAULTS,
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM bad_{t.removeprefix('order_') if t == 'order_items' else t}"
        for t, cols in _REQUIRED.items()
        for c in cols
    ),
)
ORACLES["dq_email_format"] = _report(_FAULTS, "SELECT id, email FROM bad_customers WHERE NOT (email LIKE '%_@_%')")
ORACLES["dq_country_format"] = _report(
    _FAULTS, "SELECT id, country FROM bad_customers WHERE country IS NOT NULL AND NOT regexp_matches(country, '^[A-Z]{2}$')"
)
ORACLES["dq_email_duplicates"] = _report(
    _FAULTS,
    "SELECT lower(email) AS email_key, COUNT(*) AS row_count FROM bad_customers GROUP BY 1 HAVING COUNT(*) > 1",
)
ORACLES["dq_category_name_duplicates"] = _report(
    _FAULTS, "SELECT name, COUNT(*) AS row_count FROM bad_categories GROUP BY 1 HAVING COUNT(*) > 1"
)
ORACLES["dq_order_status"] = _report(
    _FAULTS,
    "SELECT id, status FROM bad_orders WHERE status IS NULL OR status NOT IN ('pending', 'completed', 'cancelled')",
)
ORACLES["dq_ranges"] = _report(
    _FAULTS,
    """
SELECT 'products.price >= 0' AS rule, COUNT(*) FILTER (WHERE price < 0) AS violations FROM bad_products
UNION ALL SELECT 'products.stock_quantity >= 0', COUNT(*) FILTER (WHERE stock_quantity < 0) FROM bad_products
UNION ALL SELECT 'orders.total_amount >= 0', COUNT(*) FILTER (WHERE total_amount < 0) FROM bad_orders
UNION ALL SELECT 'order_items.quantity > 0', COUNT(*) FILTER (WHERE quantity <= 0) FROM bad_items
UNION ALL SELECT 'order_items.unit_price >= 0', COUNT(*) FILTER (WHERE unit_price < 0) FROM bad_items""",
)
ORACLES["dq_orphans"] = _report(
    _FAULTS,
    """
SELECT 'categories.parent_id' AS rule, CAST(parent_id AS BIGINT) AS key FROM bad_categories x
WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bad_categories p WHERE p.id = x.parent_id)
UNION ALL
SELECT 'products.category_id', CAST(category_id AS BIGINT) FROM bad_products x
WHERE category_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bad_categories p WHERE p.id = x.category_id)
UNION ALL
SELECT 'orders.customer_id', customer_id FROM bad_orders x
WHERE NOT EXISTS (SELECT 1 FROM bad_customers p WHERE p.id = x.customer_id)
UNION ALL
SELECT 'order_items.order_id', order_id FROM bad_items x
WHERE NOT EXISTS (SELECT 1 FROM bad_orders p WHERE p.id = x.order_id)
UNION ALL
SELECT 'order_items.product_id', product_id FROM bad_items x
WHERE NOT EXISTS (SELECT 1 FROM bad_products p WHERE p.id = x.product_id)""",
)
ORACLES["dq_item_duplicates"] = _report(
    "",
    "SELECT order_id, product_id, COUNT(*) AS row_count FROM shop_items GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
ORACLES["order_total_reconcile"] = _report(
    "",
    """
SELECT o.id AS order_id, CAST(o.total_amount AS DOUBLE) AS total_amount,
       CAST(COALESCE(i.t, 0) AS DOUBLE) AS items_total,
       CAST(o.total_amount - COALESCE(i.t, 0) AS DOUBLE) AS difference
FROM shop_orders o
LEFT JOIN (SELECT order_id, SUM(quantity * unit_price) AS t FROM shop_items GROUP BY 1) i ON i.order_id = o.id
WHERE o.total_amount <> COALESCE(i.t, 0)""",
)
ORACLES["table_row_counts"] = _report(
    "",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {v}" for t, v in _MODEL_VIEW.items()
    ),
)

# ---- T: refresh and layout ----------------------------------------------------
ORACLES["customer_monthly_summary_refresh"] = ORACLES["customer_monthly_summary"]
ORACLES["orders_by_month"] = _report(
    "",
    f"""
SELECT id, customer_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, status,
       CAST(total_amount AS DOUBLE) AS total_amount,
       strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at,
       strftime({local_month('order_date')}, '%Y-%m') AS order_month
FROM shop_orders""",
)

# ---- E: outputs ----------------------------------------------------------------


ORACLES["report_titles"] = f"""
SELECT product_id AS "Product ID", product_name AS "Product", category AS "Category",
       parent_category AS "Parent Category", total_revenue AS "Total Revenue", units_sold AS "Units Sold",
       category_revenue_rank AS "Category Rank", category_revenue_share_pct AS "Category Share %",
       last_month AS "Last Month", last_month_revenue AS "Last Month Revenue",
       prev_month_revenue AS "Previous Month Revenue", mom_revenue_change AS "MoM Change",
       mom_revenue_change_pct AS "MoM Change %",
       CASE WHEN is_top_20_pct_in_category THEN 'Yes' ELSE 'No' END AS "Top 20% in Category"
FROM ({ORACLES["product_performance"]}) t"""
_TREND_BODY = ORACLES["sales_trend"]
ORACLES["report_keys"] = f"""
SELECT day, day_of_week, total_orders AS orders, revenue, revenue_7d_avg, orders_7d_avg,
       revenue_vs_avg_pct, anomaly_flag AS anomaly
FROM ({_TREND_BODY}) t"""
ORACLES["report_json"] = ORACLES["report_keys"]
_csv_cols = [
    ('"Day"', "day"),
    ('"Day of Week"', "day_of_week"),
    ('"Orders"', "CAST(total_orders AS VARCHAR)"),
    ('"Revenue"', "printf('%.2f', revenue)"),
    ('"Revenue 7d Avg"', "printf('%.2f', revenue_7d_avg)"),
    ('"Orders 7d Avg"', "printf('%.2f', orders_7d_avg)"),
    ('"Revenue vs Avg %"', "CASE WHEN revenue_vs_avg_pct IS NULL THEN NULL ELSE printf('%.2f', revenue_vs_avg_pct) END"),
    ('"Anomaly"', "anomaly_flag"),
]
ORACLES["report_csv"] = f"WITH t AS ({_TREND_BODY})\nSELECT " + ", ".join(
    f"{e} AS {n}" for n, e in _csv_cols
) + " FROM t"
ORACLES["report_head"] = f"""
SELECT * FROM ({ORACLES["rfm_segmentation"]}) t
ORDER BY rfm_score DESC, CAST(monetary_value AS DECIMAL(18, 2)) DESC, customer_id LIMIT 10"""
ORACLES["report_snapshot"] = _TREND_BODY

# ---- streams -------------------------------------------------------------------
ORACLES["stream_daily_sales"] = _report(
    "",
    f"""
SELECT {iso(local_date('order_date'))} AS day, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM shop_event_orders GROUP BY 1""",
)
ORACLES["stream_customer_monthly_summary"] = ORACLES["customer_monthly_summary"]

# ---- legacy layout -------------------------------------------------------------


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


_SPELLINGS = {
    "F": ["completed", "Completed", " complete ", "COMPLETED"],
    "O": ["pending", "Pending ", "PENDING", "pending"],
    "P": ["cancelled", "canceled", "Cancelled", " CANCELED"],
}
_legacy_status = "CASE WHEN o_orderkey % 97 = 0 THEN NULL {whens} END".format(
    whens=" ".join(
        f"WHEN o_orderstatus = '{code}' THEN ({_sql_list(sp)})[CAST(o_orderkey % 4 + 1 AS INTEGER)]"
        for code, sp in _SPELLINGS.items()
    ),
)
_alias_case = """CASE WHEN lower(trim(status)) IN ('complete', 'completed') THEN 'completed'
       WHEN lower(trim(status)) = 'pending' THEN 'pending'
       WHEN lower(trim(status)) IN ('canceled', 'cancelled') THEN 'cancelled' END"""
ORACLES["normalise_legacy_orders"] = f"""
WITH lo AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 101 <> 0 THEN o_orderdate + INTERVAL 7 HOUR END AS order_date,
         {_legacy_status} AS status,
         CAST(CASE WHEN o_orderkey % 113 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(10,2)) AS total_amount
  FROM orders
), n AS (
  SELECT *, {_alias_case} AS st FROM lo
)
SELECT CAST(id AS BIGINT) AS id, CAST(customer_id AS BIGINT) AS customer_id,
       strftime(order_date - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS order_date,
       st AS status,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CASE WHEN customer_id IS NULL THEN 'customer_id missing'
            WHEN order_date IS NULL THEN 'order_date missing'
            WHEN st IS NULL THEN 'unknown status'
            WHEN total_amount IS NULL OR total_amount < 0 THEN 'bad total_amount' END AS reject_reason
FROM n"""
ORACLES["normalise_legacy_rejects"] = (
    f"SELECT * FROM ({ORACLES['normalise_legacy_orders']}) t WHERE reject_reason IS NOT NULL"
)
ORACLES["normalise_legacy_products"] = _report(
    """
lp AS (
  SELECT p_partkey AS id, p_name AS name,
         CASE WHEN p_partkey % 50 = 0 THEN NULL
              WHEN p_partkey % 41 = 0 THEN 'no such category'
              WHEN p_partkey % 3 = 0 THEN lower(p_type || ' ' || p_brand)
              WHEN p_partkey % 3 = 1 THEN ' ' || p_type || ' ' || p_brand || ' '
              ELSE p_type || ' ' || p_brand END AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST((p_partkey * 37) % 31 AS INTEGER) AS stock_quantity
  FROM part
)""",
    """
SELECT CAST(lp.id AS BIGINT) AS id, lp.name, CAST(c.id AS BIGINT) AS category_id,
       CAST(lp.price AS DOUBLE) AS price, CAST(lp.stock_quantity AS BIGINT) AS stock_quantity,
       CASE WHEN lp.category IS NOT NULL AND c.id IS NULL THEN 'unknown category' END AS reject_reason
FROM lp LEFT JOIN shop_categories c ON lower(trim(c.name)) = lower(trim(lp.category))""",
)

# ---- G: generated data that can be stated in SQL --------------------------------
ORACLES["gen_order_totals"] = _report(
    "",
    """
SELECT o.id, o.customer_id, strftime(o.order_date, '%Y-%m-%d %H:%M:%S') AS order_date, o.status,
       CAST(COALESCE(t.total, 0) AS DOUBLE) AS total_amount,
       strftime(o.updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM shop_orders o
LEFT JOIN (SELECT order_id, SUM(quantity * unit_price) AS total FROM shop_items GROUP BY 1) t ON t.order_id = o.id""",
)
_DOCUMENT = (
    '{"report_type":"daily_sales","date":"2001-07-20","data":{"total_revenue":%s,"total_orders":%d,'
    '"average_order_value":%s,"top_category":%s},"generated_at":"2001-07-21T00:00:00Z"}'
)
ORACLES["daily_sales_payload"] = f"""
SELECT printf('{_DOCUMENT}', total_revenue, total_orders, average_order_value,
              CASE WHEN top_category IS NULL THEN 'null' ELSE '"' || top_category || '"' END) AS payload
FROM ({ORACLES["daily_sales_summary"]}) t"""
ORACLES["daily_sales_summary_month_layout"] = ORACLES["daily_sales_summary"]
ORACLES["customer_cohort_from_summary"] = ORACLES["customer_cohort"]
ORACLES["frequent_customers_top_from_summary"] = ORACLES["frequent_customers_top"]
ORACLES["report_run_all"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS report, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM ({ORACLES[name]}) t"
    for name in (
        "customer_cohort",
        "product_performance",
        "rfm_segmentation",
        "sales_trend",
        "inventory_turnover",
        "purchase_patterns",
        "daily_sales_summary",
        "monthly_revenue_breakdown",
    )
)

# the same reports over another layout of orders and lines
for _name in ("product_sales", "product_performance", "inventory_turnover", "low_stock_alerts"):
    ORACLES[f"{_name}_order_layout"] = ORACLES[_name]
ORACLES["monthly_revenue_order_layout"] = ORACLES["monthly_revenue_breakdown"]

# ---- G: drawn data.  A draw is the first 15 hex digits of an MD5; the tables of the
# inverse distributions are computed here, by DuckDB.
_SEED = 42
_START = f"TIMESTAMP '{C.AS_OF.isoformat()} 00:00:00'"


def _draw(salt: str, key: str, seed: int = _SEED) -> str:
    return f"CAST('0x' || substr(md5('{seed}|{salt}|' || {key}), 1, 15) AS BIGINT)"


def _second(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


_TABLES = """
weight_steps AS (SELECT i, CAST(round(1000 * exp(3 * i / 128.0)) AS BIGINT) AS v FROM range(129) r(i)),
halving_steps AS (SELECT i, CAST(round(-1000000 * log2(1 - i / 128.0)) AS BIGINT) AS v FROM range(65) r(i))"""

_WEIGHTS = f"""
popularity AS (
  SELECT id AS product_id, a.v + (b.v - a.v) * (d % 8192) // 8192 AS w
  FROM (SELECT id, {_draw('weight', 'id')} % 1048576 AS d FROM shop_products) p
  JOIN weight_steps a ON a.i = d // 8192
  JOIN weight_steps b ON b.i = d // 8192 + 1
)"""

_DRAWN_ORDERS = f"""
buyers AS (
  SELECT id, created_at, tenure,
         (((60 - length(bin(whole))) * 1000000 + a.v + (b.v - a.v) * (part % 16384) // 16384) * 693147) // 1000000 AS e,
         CASE WHEN {_draw('heavy', 'id')} % 100 < 5 THEN 4 ELSE 1 END AS heavy
  FROM (
    SELECT id, created_at, date_diff('second', created_at, {_START}) AS tenure,
           {_draw('count', 'id')} AS whole, {_draw('count-rest', 'id')} % 1048576 AS part
    FROM shop_customers WHERE {_draw('none', 'id')} % 100 >= 15
  ) c
  JOIN halving_steps a ON a.i = part // 16384
  JOIN halving_steps b ON b.i = part // 16384 + 1
),
bought AS (
  SELECT id * 1000000 + g AS id, id AS customer_id, created_at, tenure
  FROM (SELECT *, unnest(range(1, 2 + CAST(e * heavy * 18 * tenure // (730 * 86400 * CAST(1000000 AS BIGINT)) AS BIGINT))) AS g
        FROM buyers)
),
dated AS (
  SELECT id, customer_id,
         created_at + to_seconds(({_draw('date', 'id')} % 2147483648) * tenure // 2147483648) AS order_date,
         {_draw('status', 'id')} % 100 AS percent
  FROM bought
),
drawn_orders AS (
  SELECT *, CASE WHEN order_date > {_START} - INTERVAL 2 DAY
                 THEN CASE WHEN percent >= 93 THEN 'cancelled' WHEN percent >= 60 THEN 'completed' ELSE 'pending' END
                 ELSE CASE WHEN percent >= 97 THEN 'pending' WHEN percent >= 87 THEN 'cancelled' ELSE 'completed' END
            END AS status
  FROM dated
)"""

ORACLES["gen_product_weights"] = with_model(f"""
{_TABLES.strip()}, {_WEIGHTS}
SELECT product_id, CAST(w AS DOUBLE) / 1000 AS weight FROM popularity
""")

ORACLES["gen_orders"] = with_model(f"""
{_TABLES.strip()}, {_DRAWN_ORDERS}
SELECT id, customer_id, {_second('order_date')} AS order_date, status, CAST(0 AS DOUBLE) AS total_amount,
       {_second(f'''CASE status WHEN 'pending' THEN order_date
           ELSE least(order_date + to_seconds({_draw('updated', 'id')} % 259200), {_START}) END''')} AS updated_at
FROM drawn_orders
""")

# 16 points an order: among hundreds of products they always hold five distinct ones
ORACLES["gen_order_items"] = with_model(f"""
{_TABLES.strip()}, {_WEIGHTS}, {_DRAWN_ORDERS},
stocked AS (
  SELECT kind, product_id, price, w,
         sum(w) OVER (PARTITION BY kind ORDER BY {_draw('part', 'product_id', 0)} % 1024, product_id) AS hi
  FROM popularity JOIN shop_products s ON s.id = product_id
  JOIN (VALUES (0), (1)) k(kind) ON kind = 1 OR is_active
),
offered AS (SELECT kind, product_id, price, CAST(hi - w AS BIGINT) AS lo FROM stocked),
sums AS (SELECT kind, count(*) AS products, CAST(sum(w) AS BIGINT) AS weight FROM stocked GROUP BY kind),
wanted AS (
  SELECT order_id, kind, weight, least(products, 1 + side * side * 5 // (CAST(1 AS BIGINT) << 48)) AS want
  FROM (SELECT id AS order_id, CASE WHEN order_date < {_START} - INTERVAL 180 DAY THEN 1 ELSE 0 END AS kind,
               {_draw('n_items', 'id')} % 16777216 AS side FROM drawn_orders) o
  JOIN sums USING (kind)
),
points AS (
  SELECT order_id, kind, want, t, {_draw('product', "order_id || '|' || t")} % weight AS spot
  FROM wanted, range(1, 17) r(t)
),
swept AS (
  SELECT order_id, want, t, kind, max(start) OVER (PARTITION BY kind ORDER BY spot, t) AS lo
  FROM (SELECT order_id, want, t, kind, spot, CAST(NULL AS BIGINT) AS start FROM points
        UNION ALL SELECT NULL, NULL, 0, kind, lo, lo FROM offered)
),
hits AS (
  SELECT order_id, want, product_id, price, min(t) AS t
  FROM swept JOIN offered USING (kind, lo) WHERE order_id IS NOT NULL
  GROUP BY ALL
),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY t) AS pos FROM hits
),
priced AS (
  SELECT order_id * 10 + pos AS id, order_id, product_id, CAST(price * 100 AS BIGINT) AS c,
         {_draw('qty', "order_id || '|' || product_id")} % 100 AS q,
         {_draw('disc', "order_id || '|' || product_id")} % 100 AS d,
         8000 + {_draw('rate', "order_id || '|' || product_id")} % 1501 AS rate
  FROM lines WHERE pos <= want
)
SELECT id, order_id, product_id,
       CAST(1 + (q >= 80)::INT + (q >= 95)::INT AS BIGINT) AS quantity,
       CAST(CASE WHEN d < 70 THEN c ELSE (c * rate + 5000) // 10000 END AS DOUBLE) / 100 AS unit_price
FROM priced
""")

ORACLES["gen_stock"] = with_model(f"""
sold AS (
  SELECT product_id, sum(quantity) AS units FROM shop_items i JOIN shop_orders o ON o.id = i.order_id
  WHERE o.status = 'completed' AND o.order_date >= {_START} - INTERVAL 90 DAY GROUP BY product_id
),
covers(percent, low, high) AS (VALUES (0, 0, 0), (8, 100, 650), (20, 700, 2900), (40, 3000, 9000), (80, 9100, 27100)),
luck AS (
  SELECT p.*, COALESCE(units, 0) AS units, {_draw('stock', 'p.id')} % 100 AS percent, {_draw('spread', 'p.id')} AS spread
  FROM shop_products p LEFT JOIN sold ON product_id = p.id
)
SELECT id, name, category_id, CAST(price AS DOUBLE) AS price,
       CAST(CASE WHEN units > 0 THEN (units * (low + spread % (high - low + 1)) + 8999) // 9000
                 WHEN l.percent < 70 THEN 20 + spread % 180 ELSE 0 END AS BIGINT) AS stock_quantity,
       is_active, {_second('created_at')} AS created_at
FROM luck l ASOF JOIN covers c ON l.percent >= c.percent
""")
