"""Ad-hoc and lookup queries.

``frequent_customers_*``: customers with more than ``min_orders`` orders since
a day, by revenue.  The join-first form is the original query; the agg-first
form groups orders on customer_id alone, applies HAVING, and only then joins
the (few) survivors to customers - the rewrite that keeps the shuffle on one
narrow key and joins after the filter.  Catalyst does not do that rewrite by
itself (an aggregate above a join stays above it), so both forms are kept and
compared by ``frequent_customers_diff``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money
from kassa.sources.model import Shop

MIN_ORDERS = 5
TOP_N = 100


def _since(since: dt.date, tz: str):
    return F.col("order_date") >= tu.ts_literal(tu.utc_instant(since, tz))


def frequent_customers_join_first(
    shop: Shop, since: dt.date, min_orders: int = MIN_ORDERS, tz: str = tu.REPORT_TZ
) -> DataFrame:
    c = shop.customers.alias("c")
    o = shop.orders.alias("o")
    return (
        c.join(o, F.col("c.id") == F.col("o.customer_id"), "left")
        .filter(_since(since, tz))  # rejects NULLs: Catalyst makes the join inner
        .groupBy("c.id", "c.name", "c.email")
        .agg(F.count("o.id").alias("order_count"), F.sum("o.total_amount").alias("_revenue"))
        .filter(F.col("order_count") > min_orders)
        .select(
            "name",
            "email",
            F.col("order_count").cast(LongType()).alias("order_count"),
            money(F.col("_revenue")).alias("total_revenue"),
            "_revenue",
        )
        .orderBy(F.col("_revenue").desc())
        .drop("_revenue")
    )


def _customer_totals(orders: DataFrame, since: dt.date, min_orders: int, tz: str) -> DataFrame:
    return (
        orders.filter(_since(since, tz))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("_revenue"))
        .filter(F.col("order_count") > min_orders)
    )


def frequent_customers_agg_first(
    shop: Shop, since: dt.date, min_orders: int = MIN_ORDERS, tz: str = tu.REPORT_TZ
) -> DataFrame:
    totals = _customer_totals(shop.orders, since, min_orders, tz)
    cust = shop.customers.select(F.col("id").alias("customer_id"), "name", "email")
    return (
        totals.join(cust, "customer_id")
        .select(
            "name",
            "email",
            F.col("order_count").cast(LongType()).alias("order_count"),
            money(F.col("_revenue")).alias("total_revenue"),
            "_revenue",
        )
        .orderBy(F.col("_revenue").desc())
        .drop("_revenue")
    )


def frequent_customers_top(
    shop: Shop, since: dt.date, n: int = TOP_N, min_orders: int = MIN_ORDERS, tz: str = tu.REPORT_TZ
) -> DataFrame:
    """Completed orders only, top ``n`` by revenue (the limit is the report):
    planned as TakeOrderedAndProject, a per-partition top-n then one merge."""
    totals = _customer_totals(shop.completed_orders(), since, min_orders, tz)
    cust = shop.customers.select(F.col("id").alias("customer_id"), "name", "email")
    return (
        totals.join(cust, "customer_id")
        .orderBy(F.col("_revenue").desc(), F.col("customer_id"))
        .limit(n)
        .select(
            "customer_id",
            "name",
            "email",
            F.col("order_count").cast(LongType()).alias("order_count"),
            money(F.col("_revenue")).alias("total_revenue"),
        )
    )


def frequent_customers_diff(
    shop: Shop, since: dt.date, min_orders: int = MIN_ORDERS, tz: str = tu.REPORT_TZ
) -> DataFrame:
    """Rows in one form and not the other (multiset difference both ways);
    expected to be empty."""
    a = frequent_customers_join_first(shop, since, min_orders, tz)
    b = frequent_customers_agg_first(shop, since, min_orders, tz)
    return a.exceptAll(b).withColumn("only_in", F.lit("join_first")).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit("agg_first"))
    )


def _customer_row(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "email", "name", F.coalesce("country", F.lit("")).alias("country"), "created_at"
    )


def customer_by_id(shop: Shop, customer_id: int) -> DataFrame:
    return _customer_row(shop.customers.filter(F.col("id") == F.lit(customer_id)))


def customer_by_email(shop: Shop, email: str) -> DataFrame:
    return _customer_row(shop.customers.filter(F.lower("email") == F.lower(F.lit(email))))



def frequent_customers_top_from_summary(
    shop: Shop, summary: DataFrame, since: dt.date, n: int = TOP_N, min_orders: int = MIN_ORDERS
) -> DataFrame:
    """``frequent_customers_top`` answered from the (customer, month) summary
    of completed orders, exact when ``since`` is the first day of a month:
    the scan is the summary's months from ``since`` on, not the orders."""
    if since.day != 1:
        raise ValueError("the monthly summary answers only from the first day of a month")
    totals = (
        summary.filter(F.col("order_month") >= tu.date_literal(since))
        .groupBy("customer_id")
        .agg(F.sum("order_count").alias("order_count"), F.sum("revenue").alias("_revenue"))
        .filter(F.col("order_count") > min_orders)
    )
    cust = shop.customers.select(F.col("id").alias("customer_id"), "name", "email")
    return (
        totals.join(cust, "customer_id")
        .orderBy(F.col("_revenue").desc(), F.col("customer_id"))
        .limit(n)
        .select(
            "customer_id",
            "name",
            "email",
            F.col("order_count").cast(LongType()).alias("order_count"),
            money(F.col("_revenue")).alias("total_revenue"),
        )
    )
