"""Change records of orders, derived from the driver tables by key.

Fixed values, for an order changed at or after ``since``, by id mod 5:
  0  belonged to the customer with the next smaller id (customer 1: to itself)
  1  was dated 45 days earlier
  2  was pending
  3  is new: no image before
  4  had an amount greater by 1.00
and for every such order with id mod 7 = 0 there was a second, completed order
(id negated, ten days earlier, same amount) that has been deleted since.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.functions import timeutil as tu
from kassa.operators.summary_table import IMAGE
from kassa.sources.model import STATUS_COMPLETED, STATUS_PENDING, Shop


def order_changes(shop: Shop, since: dt.datetime) -> DataFrame:
    """id, then the images before and after (``old_``, ``new_``)."""
    o = shop.orders.where(F.col("updated_at") >= tu.ts_literal(since))
    kind = F.col("id") % 5
    old = F.when(
        kind != 3,
        F.struct(
            F.when((kind == 0) & (F.col("customer_id") > 1), F.col("customer_id") - 1)
            .otherwise(F.col("customer_id"))
            .alias("customer_id"),
            F.when(kind == 1, F.col("order_date") - F.expr("INTERVAL 45 DAYS"))
            .otherwise(F.col("order_date"))
            .alias("order_date"),
            F.when(kind == 2, F.lit(STATUS_PENDING)).otherwise(F.col("status")).alias("status"),
            F.when(kind == 4, F.col("total_amount") + 1)
            .otherwise(F.col("total_amount"))
            .cast("decimal(12,2)")
            .alias("total_amount"),
        ),
    )
    changed = o.withColumn("_old", old).select(
        "id",
        *[F.col(f"_old.{c}").alias(f"old_{c}") for c in IMAGE],
        *[F.col(c).alias(f"new_{c}") for c in IMAGE],
    )
    deleted = o.where(F.col("id") % 7 == 0).select(
        (-F.col("id")).alias("id"),
        F.col("customer_id").alias("old_customer_id"),
        (F.col("order_date") - F.expr("INTERVAL 10 DAYS")).alias("old_order_date"),
        F.lit(STATUS_COMPLETED).alias("old_status"),
        F.col("total_amount").alias("old_total_amount"),
        *[F.lit(None).cast(o.schema[c].dataType).alias(f"new_{c}") for c in IMAGE],
    )
    return changed.unionByName(deleted)


def orders_before(shop: Shop, changes: DataFrame, since: dt.datetime) -> DataFrame:
    """The orders as they stood before ``changes``."""
    same = shop.orders.where(F.col("updated_at") < tu.ts_literal(since)).select(*IMAGE)
    old = changes.where("old_customer_id IS NOT NULL").select(*[F.col(f"old_{c}").alias(c) for c in IMAGE])
    return same.unionByName(old)
