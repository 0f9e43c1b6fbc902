"""Daily sales summary: exactly one row for a local day, even an empty one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from kassa.functions import timeutil as tu
from kassa.functions.money import money_text, ratio
from kassa.operators.shared import product_categories
from kassa.sources.model import Shop, item_revenue


def daily_sales_summary(shop: Shop, day: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """total_orders, total_revenue (text), average_order_value (text),
    top_category (top-level category with the highest line revenue that day,
    ties to the alphabetically first; NULL when the day has no lines).

    The day's orders are a pushed range filter; the global aggregate always
    yields one row; the top category is a scalar subquery over the per-category
    aggregate (one row per top-level category).
    """
    day_orders = shop.completed_orders_between(day, day + dt.timedelta(days=1), tz).select(
        F.col("id").alias("order_id"), "total_amount"
    )
    zero = F.lit(0).cast(DecimalType(38, 2))
    totals = day_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("total_amount"), zero).alias("_revenue"),
    )
    cats = product_categories(shop).select("product_id", F.col("parent_category").alias("category"))
    category_revenue = (
        day_orders.select("order_id")
        .join(
            shop.items_for_days(day, day + dt.timedelta(days=1)).select(
                "order_id", "product_id", item_revenue().alias("_rev")
            ),
            "order_id",
        )
        .join(cats, "product_id")
        .groupBy("category")
        .agg(F.sum("_rev").alias("revenue"))
    )
    top = (
        category_revenue.orderBy(F.col("revenue").desc(), F.col("category").asc())
        .limit(1)
        .select("category")
        .scalar()
    )
    avg = F.coalesce(ratio(F.col("_revenue"), F.col("total_orders")), zero)
    return totals.select(
        "total_orders",
        money_text(F.col("_revenue")).alias("total_revenue"),
        money_text(avg).alias("average_order_value"),
        top.alias("top_category"),
    )
