"""Product performance: revenue rank and share inside the product's category,
last month against the month before, top-20% flag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.functions import timeutil as tu
from kassa.functions.money import money, ratio
from kassa.operators.sequence import RANK, SIZE, _total, number_rows
from kassa.operators.shared import product_categories, product_sales
from kassa.sources.model import Shop


def product_performance(shop: Shop, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Products with at least one completed sale.

    Rank, percent rank, group size and the category's total come from one
    range-partitioned numbering (a category holding most products is still
    spread over many tasks); names join last.
    """
    last_month = tu.add_months(tu.month_start(as_of), -1)
    sales = product_sales(shop, as_of=as_of, tz=tz)
    cats = product_categories(shop)
    j = sales.join(cats.select("product_id", "category_id"), "product_id").select(
        "product_id", "category_id", "units_sold", "revenue", "last_month_revenue", "prev_month_revenue"
    )
    ranked = number_rows(
        j,
        ["category_id"],
        [("revenue", False), ("product_id", True)],
        rank_by=["revenue"],
        totals=["revenue"],
    )
    r = ranked.join(cats.drop("category_id"), "product_id")
    change = F.col("last_month_revenue") - F.col("prev_month_revenue")
    # percent_rank = (rank-1)/(n-1) < 0.2, tested without division
    top = (F.col(SIZE) == 1) | ((F.col(RANK) - 1) * 5 < F.col(SIZE) - 1)
    return r.select(
        "product_id",
        "product_name",
        "category",
        "parent_category",
        money(F.col("revenue")).alias("total_revenue"),
        "units_sold",
        F.col(RANK).alias("category_revenue_rank"),
        money(ratio(F.col("revenue") * 100, F.col(_total("revenue")))).alias(
            "category_revenue_share_pct"
        ),
        F.lit(last_month.strftime("%Y-%m")).alias("last_month"),
        money(F.col("last_month_revenue")).alias("last_month_revenue"),
        money(F.col("prev_month_revenue")).alias("prev_month_revenue"),
        money(change).alias("mom_revenue_change"),
        money(ratio(change * 100, F.col("prev_month_revenue"))).alias("mom_revenue_change_pct"),
        top.alias("is_top_20_pct_in_category"),
    ).orderBy("category", "category_revenue_rank", "product_id")


def monthly_revenue_breakdown(shop: Shop, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Last month against the month before, per (top-level, own) category."""
    sales = product_sales(shop, as_of=as_of, tz=tz)
    cats = product_categories(shop)
    last_month = tu.add_months(tu.month_start(as_of), -1)
    g = (
        sales.join(cats, "product_id")
        .groupBy("parent_category", "category")
        .agg(
            F.sum("last_month_revenue").alias("lm"),
            F.sum("prev_month_revenue").alias("pm"),
        )
    )
    change = F.col("lm") - F.col("pm")
    return g.select(
        "parent_category",
        "category",
        F.lit(last_month.strftime("%Y-%m")).alias("last_month"),
        money(F.col("lm")).alias("last_month_revenue"),
        money(F.col("pm")).alias("prev_month_revenue"),
        money(change).alias("mom_revenue_change"),
        money(ratio(change * 100, F.col("pm"))).alias("mom_revenue_change_pct"),
    ).orderBy("parent_category", "category")
