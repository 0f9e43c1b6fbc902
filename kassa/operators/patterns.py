"""Customer purchase patterns and the per-customer order sequence."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money
from kassa.operators.sequence import ROW, SIZE, _prev, number_rows
from kassa.operators.shared import product_categories
from kassa.sources.model import Shop

MIN_ORDERS = 3
MICROS_PER_DAY = 86_400_000_000


def _completed(shop: Shop, customers: DataFrame | None = None) -> DataFrame:
    o = shop.completed_orders().select(
        F.col("id").alias("order_id"), "customer_id", "order_date", "total_amount"
    )
    if customers is not None:
        o = o.join(customers, "customer_id", "left_semi")
    return o


def order_sequence(shop: Shop, customers: DataFrame | None = None) -> DataFrame:
    """Completed orders numbered per customer by (order_date, id), with the
    gap to the previous order in days and the customer's total.

    Uses the range-partitioned numbering, so one customer with a third of all
    orders is spread over many tasks instead of one window partition.
    """
    return _sequence(_completed(shop, customers))


def _sequence(o: DataFrame) -> DataFrame:
    seq = number_rows(
        o,
        ["customer_id"],
        [("order_date", True), ("order_id", True)],
        lag=["order_date"],
    )
    gap = tu.micros_between(F.col(_prev("order_date")), F.col("order_date"))
    return seq.select(
        "order_id",
        "customer_id",
        "order_date",
        "total_amount",
        gap.alias("gap_micros"),
        F.col(ROW).alias("order_no"),
        F.col(SIZE).alias("total_orders"),
    )


def order_sequence_report(shop: Shop) -> DataFrame:
    s = order_sequence(shop)
    days = F.col("gap_micros").cast(DecimalType(38, 0)) / F.lit(MICROS_PER_DAY).cast(DecimalType(20, 0))
    return s.select(
        "order_id",
        "customer_id",
        "order_date",
        money(F.col("total_amount")).alias("total_amount"),
        F.round(days, 6).cast("double").alias("days_since_prev"),
        "order_no",
        "total_orders",
    )


def purchase_patterns(
    shop: Shop, year: int = 2024, *, min_orders: int = MIN_ORDERS, tz: str = tu.REPORT_TZ
) -> DataFrame:
    """Customers with a completed order in ``year`` (local), measured over
    their whole completed history, kept when they have >= min_orders orders."""
    in_year = (
        shop.completed_orders_between(dt.date(year, 1, 1), dt.date(year + 1, 1, 1), tz)
        .select("customer_id")
        .distinct()
    )
    seq = order_sequence(shop, in_year)  # written once, as ranges; both branches below read those
    gap_days_dbl = F.col("gap_micros") / F.lit(float(MICROS_PER_DAY))
    amount = F.col("total_amount")
    patterns = (
        seq.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("gap_micros").cast(DecimalType(38, 0)).alias("_gap_sum"),
            F.count("gap_micros").alias("_gap_n"),
            F.stddev_samp(gap_days_dbl).alias("_gap_sd"),
            F.sum(amount).alias("_amount_sum"),
            F.sum(F.when(F.col("order_no") <= 3, amount)).alias("_first3"),
            F.sum(F.when(F.col("order_no") > F.col("total_orders") - 3, amount)).alias("_last3"),
            F.max(tu.local_date("order_date", tz)).alias("_last_day"),
            F.min(tu.local_date("order_date", tz)).alias("_first_day"),
        )
        .filter(F.col("total_orders") >= min_orders)
    )
    # line items per top-level category for the customers that survived
    lines = (
        seq.where(F.col("total_orders") >= min_orders)
        .select("order_id", "customer_id")
        .join(shop.order_items.select("order_id", "product_id"), "order_id")
        .join(product_categories(shop).select("product_id", "parent_category"), "product_id")
        .groupBy("customer_id", F.col("parent_category").alias("category"))
        .agg(F.count(F.lit(1)).alias("line_items"))
    )
    # rows per customer are bounded by the number of top-level categories
    w = Window.partitionBy("customer_id").orderBy(F.col("line_items").desc())
    favourite = (
        lines.withColumn("_r", F.rank().over(w))
        .filter(F.col("_r") == 1)
        .groupBy("customer_id")
        .agg(F.array_join(F.array_sort(F.collect_list("category")), ", ").alias("most_purchased_category"))
    )
    wide = DecimalType(20, 0)
    avg_gap = F.col("_gap_sum") / (F.col("_gap_n").cast(wide) * F.lit(MICROS_PER_DAY).cast(wide))
    cust = shop.customers.select(F.col("id").alias("customer_id"), "name", "email")
    return (
        patterns.join(cust, "customer_id")
        .join(favourite, "customer_id", "left")
        .select(
            "customer_id",
            "name",
            "email",
            F.col("total_orders").cast(LongType()).alias("total_orders"),
            F.round(avg_gap, 1).cast("double").alias("avg_days_between_orders"),
            F.round(F.col("_gap_sd"), 1).alias("stddev_days_between_orders"),
            "most_purchased_category",
            money(F.col("_amount_sum") / F.col("total_orders").cast(wide)).alias("avg_order_value"),
            F.when(F.col("_last3") > F.col("_first3"), F.lit("Increasing"))
            .otherwise(F.lit("Decreasing"))
            .alias("spending_trend"),
            F.datediff("_last_day", "_first_day").cast(LongType()).alias("lifetime_days"),
        )
        .orderBy(F.col("total_orders").desc(), "customer_id")
    )
