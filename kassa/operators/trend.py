"""Sales trend: one row per local day, trailing 7-day averages, +-30% flag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money
from kassa.operators.shared import calendar, daily_sales
from kassa.sources.model import Shop

# Fixed values of the report.
ANOMALY_THRESHOLD_PCT = 30
WARM_UP_DAYS = 6


def sales_trend(shop: Shop, days: int = 90, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Days as_of-days .. as_of-1 (local), with a 6-day warm-up so every
    reported day has a full trailing window.

    The window runs over the calendar only (days + 6 rows, fixed by the
    parameter), so its single partition does not grow with the orders.
    """
    from_day = as_of - dt.timedelta(days=days)
    to_day = as_of - dt.timedelta(days=1)
    warm_start = from_day - dt.timedelta(days=WARM_UP_DAYS)
    sales = daily_sales(shop, warm_start, to_day + dt.timedelta(days=1), tz)
    cal = calendar(shop.spark, warm_start, to_day)
    day_rows = cal.join(sales, "day", "left").select(
        "day",
        F.coalesce("total_orders", F.lit(0)).cast(LongType()).alias("total_orders"),
        F.coalesce("revenue", F.lit(0)).cast(DecimalType(22, 2)).alias("revenue"),
    )
    w = Window.orderBy("day").rowsBetween(-WARM_UP_DAYS, Window.currentRow)
    framed = day_rows.select(
        "*",
        F.sum("revenue").over(w).alias("_sum_rev"),
        F.sum("total_orders").over(w).alias("_sum_orders"),
        F.count(F.lit(1)).over(w).alias("_n"),
    )
    n = F.col("_n").cast(DecimalType(20, 0))
    sum_rev = F.col("_sum_rev").cast(DecimalType(20, 2))
    # revenue vs average in one exact division: (n*rev - sum) * 100 / sum
    excess = n * F.col("revenue").cast(DecimalType(20, 2)) - sum_rev
    pct = (excess * 100).cast(DecimalType(20, 2)) / F.nullif(sum_rev, F.lit(0).cast(DecimalType(20, 2)))
    # strict +-30% test without division: excess*100*sign(sum) vs 30*|sum|
    signed = excess * 100 * F.signum(sum_rev).cast(DecimalType(1, 0))
    bound = F.abs(sum_rev) * ANOMALY_THRESHOLD_PCT
    flag = (
        F.when(sum_rev == 0, F.lit("Normal"))
        .when(signed > bound, F.lit("Spike"))
        .when(signed < -bound, F.lit("Drop"))
        .otherwise(F.lit("Normal"))
    )
    return (
        framed.filter(F.col("day") >= tu.date_literal(from_day))
        .select(
            "day",
            F.date_format("day", "EEEE").alias("day_of_week"),
            "total_orders",
            money(F.col("revenue")).alias("revenue"),
            money(sum_rev / n).alias("revenue_7d_avg"),
            money(F.col("_sum_orders").cast(DecimalType(20, 0)) / n).alias("orders_7d_avg"),
            money(pct).alias("revenue_vs_avg_pct"),
            flag.alias("anomaly_flag"),
        )
        .orderBy("day")
    )
