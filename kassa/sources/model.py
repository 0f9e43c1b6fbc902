"""The shop data model the reports are written against.

Five tables with flat columns.  Instants are ``timestamp_ntz`` values holding
UTC wall-clock time, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Fixed values of the model: order statuses.
STATUS_PENDING = "pending"
STATUS_COMPLETED = "completed"
STATUS_CANCELLED = "cancelled"
STATUSES = (STATUS_PENDING, STATUS_COMPLETED, STATUS_CANCELLED)


def _f(name: str, dtype, nullable: bool = False) -> StructField:
    return StructField(name, dtype, nullable)


CUSTOMERS = StructType(
    [
        _f("id", LongType()),
        _f("email", StringType()),
        _f("name", StringType()),
        _f("country", StringType(), True),
        _f("created_at", TimestampNTZType()),
    ]
)
CATEGORIES = StructType(
    [_f("id", LongType()), _f("name", StringType()), _f("parent_id", LongType(), True)]
)
PRODUCTS = StructType(
    [
        _f("id", LongType()),
        _f("name", StringType()),
        _f("category_id", LongType(), True),
        _f("price", DecimalType(10, 2)),
        _f("stock_quantity", IntegerType()),
        _f("is_active", BooleanType()),
        _f("created_at", TimestampNTZType()),
    ]
)
ORDERS = StructType(
    [
        _f("id", LongType()),
        _f("customer_id", LongType()),
        _f("order_date", TimestampNTZType()),
        _f("status", StringType()),
        _f("total_amount", DecimalType(12, 2)),
        _f("updated_at", TimestampNTZType()),
    ]
)
ORDER_ITEMS = StructType(
    [
        _f("id", LongType()),
        _f("order_id", LongType()),
        _f("product_id", LongType()),
        _f("quantity", IntegerType()),
        _f("unit_price", DecimalType(10, 2)),
    ]
)

SCHEMAS = {
    "customers": CUSTOMERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}


class Shop:
    """The five model tables plus a status filter that can reach the scan.

    ``completed_orders`` exists because a source may store status in another
    encoding; a source overrides it so the predicate is pushed into its scan.
    """

    def __init__(
        self,
        customers: DataFrame,
        categories: DataFrame,
        products: DataFrame,
        orders: DataFrame,
        order_items: DataFrame,
    ):
        self.customers = customers
        self.categories = categories
        self.products = products
        self.orders = orders
        self.order_items = order_items

    def orders_in_status(self, *statuses: str) -> DataFrame:
        return self.orders.filter(F.col("status").isin(*statuses))

    def completed_orders(self) -> DataFrame:
        return self.orders_in_status(STATUS_COMPLETED)

    def completed_orders_between(self, first_day, end_day, tz: str = "Asia/Jakarta") -> DataFrame:
        """Completed orders placed in local days [first_day, end_day): a range
        on the raw instant (pushed into the scan); a shop laid out by month
        adds a partition filter on the matching months."""
        from kassa.functions import timeutil as tu

        return self.completed_orders().filter(tu.instant_range("order_date", first_day, end_day, tz))

    def items_for_days(self, first_day, end_day) -> DataFrame:
        """Order lines that can belong to orders placed in [first_day, end_day)
        (local days).  A plain shop cannot narrow this down; a shop laid out
        by order month returns only the matching month folders."""
        return self.order_items

    @property
    def spark(self):
        return self.orders.sparkSession


def item_revenue() -> Column:
    """Line revenue ``quantity * unit_price`` as an exact decimal."""
    return F.col("quantity").cast(DecimalType(10, 0)) * F.col("unit_price")
