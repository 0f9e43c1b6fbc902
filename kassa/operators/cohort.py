"""Customer cohorts: per month of first-ever completed order inside a year,
new customers, first-month revenue, running total, next-month retention and
change against the previous cohort row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money, ratio
from kassa.operators.shared import customer_monthly_summary
from kassa.sources.model import Shop


def customer_cohort(shop: Shop, year: int = 2024, *, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Only two months per customer matter (the cohort month and the one after),
    so orders are first reduced to one row per (customer, month) with a
    map-side partial aggregate; a customer with a huge history is combined
    before any shuffle.  The members are then probed with two (customer,
    month) keys each and joined to that summary on the same keys it is
    already partitioned by.
    """
    return cohort_from_monthly(customer_monthly_summary(shop, tz), year)


def cohort_from_monthly(summary: DataFrame, year: int) -> DataFrame:
    """The cohort report from a (customer_id, order_month, revenue) summary
    of completed orders - e.g. the incrementally maintained summary table,
    so the report does not read the orders at all."""
    monthly = summary.select("customer_id", F.col("order_month").alias("month"), "revenue")
    first = monthly.groupBy("customer_id").agg(F.min("month").alias("cohort_month"))
    members = first.filter(
        (F.col("cohort_month") >= tu.date_literal(dt.date(year, 1, 1)))
        & (F.col("cohort_month") < tu.date_literal(dt.date(year + 1, 1, 1)))
    )
    probes = members.select(
        "customer_id",
        "cohort_month",
        F.explode(
            F.array(
                F.struct(F.col("cohort_month").alias("month"), F.lit(0).alias("k")),
                F.struct(F.add_months("cohort_month", 1).alias("month"), F.lit(1).alias("k")),
            )
        ).alias("p"),
    ).select("customer_id", "cohort_month", F.col("p.month").alias("month"), F.col("p.k").alias("k"))
    activity = probes.join(monthly, ["customer_id", "month"], "left")
    per_member = activity.groupBy("customer_id", "cohort_month").agg(
        F.sum(F.when(F.col("k") == 0, F.col("revenue"))).alias("first_month_revenue"),
        F.max(F.when(F.col("k") == 1, F.col("revenue").isNotNull())).alias("ordered_next_month"),
    )
    cohorts = per_member.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("new_customers"),
        F.sum("first_month_revenue").alias("first_month_revenue"),
        F.count(F.when(F.col("ordered_next_month"), F.lit(1))).alias("retained_customers"),
    )
    # at most 12 rows: the global window is bounded by the calendar
    w = Window.orderBy("cohort_month")
    return cohorts.select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"),
        F.col("new_customers").cast(LongType()).alias("new_customers"),
        money(F.col("first_month_revenue")).alias("first_month_revenue"),
        F.sum("new_customers")
        .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .cast(LongType())
        .alias("running_total_customers"),
        F.col("retained_customers").cast(LongType()).alias("retained_customers"),
        money(ratio(F.col("retained_customers") * 100, F.col("new_customers"))).alias(
            "retention_rate_pct"
        ),
        (F.col("new_customers") - F.lag("new_customers").over(w)).cast(LongType()).alias(
            "new_customers_change"
        ),
        F.col("cohort_month").alias("_sort"),
    ).orderBy("_sort").drop("_sort")
