"""Driver tables -> shop model.

The driver ships TPC-H style tables; the reports are written against the shop
model of :mod:`kassa.sources.model`.  The mapping is fixed here, and the same
mapping is written as DuckDB SQL in :mod:`kassa.plans.oracle` so that results
can be checked independently.

Mapping (fixed values of the adapter):
  customers   id = c_custkey, name = c_name,
              email = lower(c_name with '#' -> '.') || '@example.com',
              country = two letters from the nation key (A + key div 26, A + key mod 26),
                        NULL for nation key 0,
              created_at = 1994-01-01 + (c_custkey * 7919 mod 730) days
  categories  parents = distinct p_type, children = distinct p_type || ' ' || p_brand;
              id = the first 15 hex digits of the MD5 of 'p:' or 'c:' and the name, as a
              number; child parent_id -> its p_type
  products    id = p_partkey, name = p_name, price = p_retailprice as decimal(10,2),
              category_id = child category, NULL when p_partkey mod 50 = 0,
              stock_quantity = (p_partkey * 37) mod 31, is_active = p_partkey mod 20 <> 0,
              created_at = 1994-01-01 + (p_partkey mod 365) days
  orders      id = o_orderkey, customer_id = o_custkey, order_date = o_orderdate (UTC),
              status F -> completed, O -> pending, P -> cancelled,
              total_amount = o_totalprice as decimal(12,2),
              updated_at = order_date + (o_orderkey mod 4) days
  order_items id = l_orderkey * 100 + l_linenumber, order_id, product_id = l_partkey,
              quantity = l_quantity as int,
              unit_price = floor(round(l_extendedprice * 100) / quantity) / 100
  event orders (time-zone tests): events with event_type = 'purchase',
              id = event_id, customer_id = user_id, order_date = ts, completed,
              total_amount = value as decimal(12,2), updated_at = ts
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from kassa.sources import model
from kassa.sources.driver_tables import DriverTables

# Driver status code -> model status.
STATUS_CODES = {"F": model.STATUS_COMPLETED, "O": model.STATUS_PENDING, "P": model.STATUS_CANCELLED}
EPOCH_DAY = "1994-01-01"


def _days_after_epoch(n):
    return F.date_add(F.lit(EPOCH_DAY).cast("date"), n.cast("int")).cast("timestamp_ntz")


def customers(t: DriverTables) -> DataFrame:
    c = t.customer
    k = F.col("c_nationkey")
    country = F.when(k == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.char(F.lit(65) + F.floor(k / 26) % 26), F.char(F.lit(65) + k % 26))
    )
    return c.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        country.alias("country"),
        _days_after_epoch(F.col("c_custkey") * 7919 % 730).alias("created_at"),
    )


def category_id(kind: str, name: F.Column) -> F.Column:
    """Stable id of a category name: 60 bits of its MD5 hash ("p" parent, "c" child)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{kind}:"), name)), 1, 15), 16, 10).cast("long")


def categories(t: DriverTables) -> DataFrame:
    # ids are hashes of the names: no numbering, so nothing is gathered in one task
    child = F.concat_ws(" ", "p_type", "p_brand")
    parents = t.part.select("p_type").distinct().select(
        category_id("p", F.col("p_type")).alias("id"),
        F.col("p_type").alias("name"),
        F.lit(None).cast("long").alias("parent_id"),
    )
    children = t.part.select("p_type", "p_brand").distinct().select(
        category_id("c", child).alias("id"), child.alias("name"), category_id("p", F.col("p_type")).alias("parent_id")
    )
    return parents.unionByName(children)


def products(t: DriverTables) -> DataFrame:
    key = F.col("p_partkey")
    own = category_id("c", F.concat_ws(" ", "p_type", "p_brand"))
    return t.part.select(
        key.alias("id"),
        F.col("p_name").alias("name"),
        F.when(key % 50 == 0, F.lit(None)).otherwise(own).cast("long").alias("category_id"),
        F.col("p_retailprice").cast(DecimalType(10, 2)).alias("price"),
        ((key * 37) % 31).cast("int").alias("stock_quantity"),
        (key % 20 != 0).alias("is_active"),
        _days_after_epoch(key % 365).alias("created_at"),
    )


def _status(code_col) -> F.Column:
    expr = None
    for code, status in STATUS_CODES.items():
        expr = (F.when if expr is None else expr.when)(code_col == code, status)
    return expr


def _orders_from(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").cast(DecimalType(12, 2)).alias("total_amount"),
        F.timestamp_add("DAY", (F.col("o_orderkey") % 4).cast("int"), F.col("o_orderdate")).alias(
            "updated_at"
        ),
    )


def orders(t: DriverTables) -> DataFrame:
    return _orders_from(t.orders)


def order_items(t: DriverTables) -> DataFrame:
    li = t.lineitem
    unit_cents = F.expr("CAST(ROUND(l_extendedprice * 100) AS BIGINT) div CAST(l_quantity AS INT)")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (unit_cents.cast(DecimalType(12, 0)) * F.lit(Decimal("0.01")))
        .cast(DecimalType(10, 2))
        .alias("unit_price"),
    )


class DriverShop(model.Shop):
    """Shop over the driver tables; status filters go to the raw status code
    so they reach the parquet scan as pushed filters.
    """

    def __init__(self, t: DriverTables):
        self.tables = t
        self.customers = customers(t)
        self.categories = categories(t)
        self.products = products(t)
        self.orders = orders(t)
        self.order_items = order_items(t)

    def orders_in_status(self, *statuses: str) -> DataFrame:
        codes = [code for code, status in STATUS_CODES.items() if status in statuses]
        return _orders_from(self.tables.orders.filter(F.col("o_orderstatus").isin(*codes)))


def event_orders(t: DriverTables) -> DataFrame:
    e = t.events.filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_date"),
        F.lit(model.STATUS_COMPLETED).alias("status"),
        F.col("value").cast(DecimalType(12, 2)).alias("total_amount"),
        F.col("ts").alias("updated_at"),
    )


class EventShop(model.Shop):
    """Shop whose orders are the purchase events: real times of day, so the
    Jakarta day differs from the UTC day for part of them."""

    def __init__(self, t: DriverTables):
        self.tables = t
        self._base = DriverShop(t)
        self.customers = self._base.customers
        self.categories = self._base.categories
        self.products = self._base.products
        self.orders = event_orders(t)
        self.order_items = self._base.order_items.filter(F.lit(False))

    def orders_in_status(self, *statuses: str) -> DataFrame:
        if model.STATUS_COMPLETED in statuses:
            return self.orders
        return self.orders.filter(F.lit(False))


def driver_shop(spark: SparkSession, root: str) -> DriverShop:
    return DriverShop(DriverTables(spark, root))


def event_shop(spark: SparkSession, root: str) -> EventShop:
    return EventShop(DriverTables(spark, root))
