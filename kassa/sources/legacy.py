"""The older, looser layout: free-text status and category, zoneless local
timestamps, nullable columns.

``legacy_orders`` / ``legacy_products`` derive such an export from the
driver tables (so the normaliser runs over data that grows with them):
spellings of a status vary with the key, some statuses are missing, times
are Jakarta wall-clock, categories are names in mixed case with padding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.functions import timeutil as tu
from kassa.sources.driver_tables import DriverTables

# Spellings used for each driver status code, picked by key mod 4.
LEGACY_SPELLINGS = {
    "F": ["completed", "Completed", " complete ", "COMPLETED"],
    "O": ["pending", "Pending ", "PENDING", "pending"],
    "P": ["cancelled", "canceled", "Cancelled", " CANCELED"],
}
MISSING_STATUS_EVERY = 97
# Rows without a customer, without a date, with a negative total
# (order keys), and with a category that does not exist (part keys).
NO_CUSTOMER_EVERY, NO_DATE_EVERY, BAD_TOTAL_EVERY, BAD_CATEGORY_EVERY = 89, 101, 113, 41


def legacy_orders(t: DriverTables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    status = None
    for code, spellings in LEGACY_SPELLINGS.items():
        pick = F.element_at(F.array(*[F.lit(s) for s in spellings]), (k % 4 + 1).cast("int"))
        status = (F.when if status is None else status.when)(F.col("o_orderstatus") == code, pick)
    status = F.when(k % MISSING_STATUS_EVERY == 0, F.lit(None).cast("string")).otherwise(status)
    return o.select(
        k.cast("long").alias("id"),
        F.when(k % NO_CUSTOMER_EVERY != 0, F.col("o_custkey")).cast("long").alias("customer_id"),
        F.when(k % NO_DATE_EVERY != 0, tu.local_time("o_orderdate")).alias("order_date"),
        status.alias("status"),
        F.when(k % BAD_TOTAL_EVERY == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .cast("decimal(10,2)")
        .alias("total_amount"),
    )


def legacy_products(t: DriverTables) -> DataFrame:
    p = t.part
    k = F.col("p_partkey")
    name = F.concat_ws(" ", "p_type", "p_brand")
    text = (
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(k % BAD_CATEGORY_EVERY == 0, F.lit("no such category"))
        .when(k % 3 == 0, F.lower(name))
        .when(k % 3 == 1, F.concat(F.lit(" "), name, F.lit(" ")))
        .otherwise(name)
    )
    return p.select(
        k.cast("long").alias("id"),
        F.col("p_name").alias("name"),
        text.alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        ((k * 37) % 31).cast("int").alias("stock_quantity"),
    )
