"""Inventory turnover: units sold in a window, daily rate, days to stock-out,
status and reorder quantity for 45 days' cover.

Thresholds are tested on integers (stock * window against k * units), and the
reorder quantity is ceil(units * 45 / window) - stock in integer arithmetic,
so no boundary depends on a rounded rate (a deliberate, exact difference from
a rate rounded before multiplying).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money
from kassa.operators.shared import product_categories, product_sales
from kassa.sources.model import Shop

# Fixed values of the report.
TARGET_COVER_DAYS = 45
CRITICAL_DAYS, LOW_DAYS, ADEQUATE_DAYS = 7, 30, 90
STATUS_ORDER = ["Critical", "Low", "Adequate", "Overstocked", "Dead Stock"]


def inventory_turnover(
    shop: Shop, days: int = 90, *, as_of: dt.date, tz: str = tu.REPORT_TZ
) -> DataFrame:
    sales = product_sales(shop, as_of=as_of, window_days=days, tz=tz).select(
        "product_id", "units_sold_window", "last_order_at"
    )
    m = product_categories(shop).join(sales, "product_id", "left")
    units = F.coalesce(F.col("units_sold_window"), F.lit(0)).cast(LongType())
    stock = F.col("stock_quantity").cast(LongType())
    m = m.select(
        "product_id", "product_name", "category", stock.alias("stock"), units.alias("units"), "last_order_at"
    ).filter((F.col("stock") > 0) | (F.col("units") > 0))
    s, u = F.col("stock"), F.col("units")
    wide = DecimalType(20, 0)
    cover = s * days  # days until stock-out = cover / units
    status = (
        F.when((u == 0) & (s > 0), F.lit("Dead Stock"))
        .when(cover < u * CRITICAL_DAYS, F.lit("Critical"))
        .when(cover < u * LOW_DAYS, F.lit("Low"))
        .when(cover <= u * ADEQUATE_DAYS, F.lit("Adequate"))
        .otherwise(F.lit("Overstocked"))
    )
    days_left = F.when(u > 0, cover.cast(wide) / u.cast(wide))
    need = (u * TARGET_COVER_DAYS + (days - 1)).cast(LongType())
    reorder = F.greatest(F.floor(need.cast(wide) / F.lit(days).cast(wide)).cast(LongType()) - s, F.lit(0))
    priority = F.array_position(F.array(*[F.lit(x) for x in STATUS_ORDER]), F.col("stock_status"))
    return (
        m.select(
            "product_id",
            "product_name",
            "category",
            F.col("stock").alias("stock_quantity"),
            F.col("units").alias("units_sold_90d"),
            money(u.cast(wide) / F.lit(days).cast(wide)).alias("daily_sales_rate"),
            F.round(days_left, 1).cast("double").alias("days_until_stockout"),
            tu.local_date("last_order_at", tz).alias("last_order_date"),
            status.alias("stock_status"),
            reorder.cast(LongType()).alias("reorder_quantity"),
        )
        .orderBy(priority, F.col("days_until_stockout").asc_nulls_last(), "product_id")
    )


def low_stock_alerts(shop: Shop, days: int = 90, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Scheduled variant: inventory rows that are Critical or Low."""
    return inventory_turnover(shop, days, as_of=as_of, tz=tz).filter(
        F.col("stock_status").isin("Critical", "Low")
    )
