"""RFM segmentation: recency and frequency bands, monetary quintile, four segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kassa.functions import timeutil as tu
from kassa.functions.money import money
from kassa.operators.sequence import ntile, number_rows
from kassa.sources.model import Shop

# Fixed values of the report: (upper bound of recency days, score), then
# (lower bound of order count, score), then (lower bound of total, segment).
RECENCY_BANDS = [(30, 5), (90, 4), (180, 3), (365, 2)]
FREQUENCY_BANDS = [(20, 5), (10, 4), (6, 3), (3, 2)]
SEGMENTS = [(12, "Champions"), (9, "Loyal"), (6, "At Risk")]
OTHER_SEGMENT = "Lost"
QUANTILES = 5


def _bands(col, bands, test, default):
    expr = None
    for bound, score in bands:
        cond = test(col, bound)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(default))


def rfm_segmentation(shop: Shop, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Customers with at least one completed order.

    The monetary quintile is NTILE(5) over all scored customers ordered by
    (monetary, customer_id).  Instead of a global window (one task sorting
    every customer) it uses the range-partitioned numbering: row number and
    total from partition summaries, then the NTILE bucket formula.
    """
    stats = (
        shop.completed_orders()
        .groupBy("customer_id")
        .agg(
            F.max(tu.local_date("order_date", tz)).alias("last_order_day"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("total_amount").alias("monetary"),
        )
        .join(shop.customers.select(F.col("id").alias("customer_id")), "customer_id", "left_semi")
    )
    # four short columns go through the numbering; names join afterwards
    numbered = number_rows(stats, [], [("monetary", True), ("customer_id", True)]).join(
        shop.customers.select(F.col("id").alias("customer_id"), "name", "email"), "customer_id"
    )
    recency = F.datediff(tu.date_literal(as_of), F.col("last_order_day"))
    scored = numbered.select(
        "customer_id",
        "name",
        "email",
        recency.cast(LongType()).alias("recency_days"),
        F.col("frequency").cast(LongType()).alias("frequency_count"),
        "monetary",
        _bands(recency, RECENCY_BANDS, lambda c, b: c <= b, 1).cast(LongType()).alias("r_score"),
        _bands(F.col("frequency"), FREQUENCY_BANDS, lambda c, b: c >= b, 1).cast(LongType()).alias("f_score"),
        ntile(QUANTILES).alias("m_score"),
    ).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    segment = _bands(F.col("rfm_score"), SEGMENTS, lambda c, b: c >= b, OTHER_SEGMENT)
    return (
        scored.select(
            "customer_id",
            "name",
            "email",
            "recency_days",
            "frequency_count",
            money(F.col("monetary")).alias("monetary_value"),
            "r_score",
            "f_score",
            "m_score",
            "rfm_score",
            segment.alias("segment"),
            "monetary",
        )
        .orderBy(F.col("rfm_score").desc(), F.col("monetary").desc(), "customer_id")
        .drop("monetary")
    )


def churn_risk(shop: Shop, *, as_of: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Scheduled variant: RFM rows in segment At Risk or Lost."""
    return rfm_segmentation(shop, as_of=as_of, tz=tz).filter(F.col("segment").isin("At Risk", "Lost"))
