"""Shared and summary tables (one aggregation reused by several reports)."""

from __future__ import annotations

import copy
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from kassa.functions import timeutil as tu
from kassa.operators.sequence import materialize
from kassa.sources.bucketed import least_buckets, write_bucketed
from kassa.sources.model import ORDER_ITEMS, ORDERS, Shop, item_revenue

UNCATEGORIZED = "Uncategorized"


def category_rollup(shop: Shop) -> DataFrame:
    """Every category with its own name and its top-level name.

    Categories are a dimension bounded by the catalogue, so this self join is
    a small-table join; Spark chooses a broadcast from the measured size.
    """
    c = shop.categories.alias("c")
    parent = shop.categories.select(
        F.col("id").alias("_pid"), F.col("name").alias("_parent_name")
    )
    return c.join(parent, F.col("c.parent_id") == F.col("_pid"), "left").select(
        F.col("c.id").alias("category_id"),
        F.col("c.name").alias("category"),
        F.coalesce(F.col("_parent_name"), F.col("c.name")).alias("parent_category"),
    )


def category_tree(shop: Shop) -> DataFrame:
    """Every category with the top of its tree, however deep: category_id, category,
    top_id, top_level, depth (0 at the top) and ``cyclic``.

    A category without a parent, or with one that is not in the table, is a top.
    One whose way up never ends, as it lies in a cycle or below one, is reported with
    ``cyclic`` set and top and depth null.  Ways double in length each round, so a
    tree of depth d takes log2(d) joins, a table with a cycle log2 of its rows; each
    round is written, which cuts its lineage.  ``category_rollup`` keeps to the direct
    parent, as the reports are defined."""
    own = shop.categories.select("id", "name", "parent_id")
    known = own.select(F.col("id").alias("parent_id"), F.lit(True).alias("_known"))
    first = materialize(
        own.join(known, "parent_id", "left").select(
            "id",
            F.when(F.col("_known"), F.col("parent_id")).otherwise(F.col("id")).alias("up"),
            F.when(F.col("_known"), 1).otherwise(0).cast(LongType()).alias("depth"),
        ),
        "category_steps",
    )
    ways = first
    for _ in range(first.count().bit_length()):
        on = ways.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_more"))
        longer = ways.join(on, "up").select("id", F.col("_up").alias("up"), "depth", "_more")
        longer = materialize(longer, "category_steps")
        ways = longer.select("id", "up", (F.col("depth") + F.col("_more")).alias("depth"))
        if longer.where("_more > 0").isEmpty():
            break
    tops = first.where("depth = 0").join(own, "id").select(F.col("id").alias("up"), F.col("name").alias("top_level"))
    names = own.select("id", F.col("name").alias("category"))
    at_top = F.col("_top").isNotNull()
    return (
        ways.join(names, "id")
        .join(tops.withColumn("_top", F.col("up")), "up", "left")
        .select(
            F.col("id").alias("category_id"),
            "category",
            F.col("_top").alias("top_id"),
            "top_level",
            F.when(at_top, F.col("depth")).alias("depth"),
            (~at_top).alias("cyclic"),
        )
    )


def product_categories(shop: Shop) -> DataFrame:
    """product_id -> category and top-level category names ('Uncategorized' when missing)."""
    roll = category_rollup(shop)
    p = shop.products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category_id",
        "stock_quantity",
    )
    return p.join(roll, "category_id", "left").select(
        "product_id",
        "product_name",
        "category_id",
        "stock_quantity",
        F.coalesce("category", F.lit(UNCATEGORIZED)).alias("category"),
        F.coalesce("parent_category", F.lit(UNCATEGORIZED)).alias("parent_category"),
    )


def daily_sales(shop: Shop, from_day: dt.date, to_day: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Completed orders and revenue per local day for days in [from_day, to_day).

    The range is compared with the raw instant so it reaches the scan; the
    group key is the local day.  Output: day, total_orders, revenue (decimal).
    """
    o = shop.completed_orders_between(from_day, to_day, tz)
    return o.groupBy(tu.local_date("order_date", tz).alias("day")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("revenue"),
    )


def product_sales(
    shop: Shop,
    *,
    as_of: dt.date,
    window_days: int = 90,
    tz: str = tu.REPORT_TZ,
) -> DataFrame:
    """One pass over completed order lines, per product:

    units_sold, revenue (all time); last_month_revenue and prev_month_revenue
    (the two calendar months before the month of ``as_of``); units_sold_window
    (since local midnight of as_of - window_days); last_order_at (all time).

    The lines are joined to the completed orders (shuffle on order_id, with
    AQE splitting a hot order) and aggregated per product with a map-side
    partial aggregate, so a hot product is combined before the shuffle.
    A shop from :func:`with_product_sales` has it computed already.
    """
    held = getattr(shop, "held_product_sales", {}).get((as_of, window_days, tz))
    if held is not None:
        return held
    this_month = tu.month_start(as_of)
    last_month = tu.add_months(this_month, -1)
    prev_month = tu.add_months(this_month, -2)
    window_start = tu.ts_literal(tu.utc_instant(as_of - dt.timedelta(days=window_days), tz))
    o = shop.completed_orders().select(
        F.col("id").alias("order_id"),
        "order_date",
        tu.local_month("order_date", tz).alias("_month"),
    )
    lines = shop.order_items.select("order_id", "product_id", "quantity", item_revenue().alias("_rev"))
    j = lines.join(o, "order_id")
    zero = F.lit(0).cast(DecimalType(38, 2))
    return j.groupBy("product_id").agg(
        F.sum("quantity").cast(LongType()).alias("units_sold"),
        F.sum("_rev").alias("revenue"),
        F.coalesce(
            F.sum(F.when(F.col("_month") == tu.date_literal(last_month), F.col("_rev"))), zero
        ).alias("last_month_revenue"),
        F.coalesce(
            F.sum(F.when(F.col("_month") == tu.date_literal(prev_month), F.col("_rev"))), zero
        ).alias("prev_month_revenue"),
        F.coalesce(
            F.sum(F.when(F.col("order_date") >= window_start, F.col("quantity"))), F.lit(0)
        ).cast(LongType()).alias("units_sold_window"),
        F.max("order_date").alias("last_order_at"),
    )


def with_product_sales(shop: Shop, *, as_of: dt.date, window_days: int = 90, tz: str = tu.REPORT_TZ) -> Shop:
    """The same shop with ``product_sales`` written once for several reports:
    the order lines are then scanned once for all of them."""
    sales = materialize(product_sales(shop, as_of=as_of, window_days=window_days, tz=tz), "product-sales")
    out = copy.copy(shop)
    out.held_product_sales = {(as_of, window_days, tz): sales}
    return out


def customer_monthly_summary(shop: Shop, tz: str = tu.REPORT_TZ) -> DataFrame:
    """One row per (customer, local month) of completed orders: count, revenue."""
    return monthly_summary(shop.completed_orders(), tz)


def monthly_summary(completed: DataFrame, tz: str = tu.REPORT_TZ) -> DataFrame:
    return completed.groupBy("customer_id", tu.local_month("order_date", tz).alias("order_month")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("revenue"),
    )


def calendar(spark, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Every day in [first_day, last_day]; size fixed by the parameters."""
    n = (last_day - first_day).days + 1
    return spark.range(0, max(n, 0), numPartitions=1).select(
        F.date_add(tu.date_literal(first_day), F.col("id").cast("int")).alias("day")
    )


def refresh_customer_monthly_summary(
    shop: Shop,
    existing: DataFrame,
    since: dt.datetime,
    tz: str = tu.REPORT_TZ,
    moved_from: DataFrame | None = None,
) -> DataFrame:
    """Incremental refresh of ``customer_monthly_summary``.

    The orders table no longer knows a moved order's former customer, so the
    change records name them: ``moved_from(customer_id)``.

    Orders changed since ``since`` (``updated_at``, UTC) name the touched
    customers.  A changed order may have left its old month (or its old
    status), so every month of a touched customer is recomputed from the
    orders, and the untouched customers' rows are kept as they are.  As a frame
    it passes every row of the table; a stored table is refreshed by
    :mod:`kassa.operators.summary_table`, at the cost of the changes alone.
    """
    touched = (
        shop.orders.filter(F.col("updated_at") >= tu.ts_literal(since)).select("customer_id").distinct()
    )
    if moved_from is not None:
        touched = touched.union(moved_from.select("customer_id")).distinct()
    keep = existing.join(touched, "customer_id", "left_anti")
    o = shop.completed_orders().join(touched, "customer_id", "left_semi")
    fresh = o.groupBy("customer_id", tu.local_month("order_date", tz).alias("order_month")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("revenue"),
    )
    return keep.unionByName(fresh.select(existing.columns))


def summary_before(shop: Shop, since: dt.datetime, tz: str = tu.REPORT_TZ) -> DataFrame:
    """The summary as it stood before ``since``: orders not updated since."""
    o = shop.completed_orders().filter(F.col("updated_at") < tu.ts_literal(since))
    return o.groupBy("customer_id", tu.local_month("order_date", tz).alias("order_month")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("revenue"),
    )


def write_orders_by_month(shop: Shop, path: str, tz: str = tu.REPORT_TZ) -> None:
    """Orders laid out in one folder per local month, so a date filter on
    ``order_month`` reads only the matching folders (partition pruning).
    A ``rebalance`` hint on the month groups rows by month before the write
    (few files per month instead of one per task and month) while AQE still
    splits a large month into advisory-size tasks."""
    month = F.date_format(tu.local_month("order_date", tz), "yyyy-MM")
    (
        shop.orders.withColumn("order_month", month)
        .hint("rebalance", "order_month")
        .write.mode("overwrite")
        .partitionBy("order_month")
        .parquet(path)
    )


def read_orders_by_month(spark, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("order_month", F.col("order_month").cast("string"))


def write_order_items_by_month(shop: Shop, path: str, tz: str = tu.REPORT_TZ) -> None:
    """Order lines laid out by their order's local month (the same folders as
    ``write_orders_by_month``), so a job over a few days of orders reads only
    those months of lines instead of the whole table."""
    month = shop.orders.select(
        F.col("id").alias("order_id"), F.date_format(tu.local_month("order_date", tz), "yyyy-MM").alias("order_month")
    )
    (
        shop.order_items.join(month, "order_id")
        .hint("rebalance", "order_month")
        .write.mode("overwrite")
        .partitionBy("order_month")
        .parquet(path)
    )


class MonthLayoutShop(Shop):
    """A shop whose orders and lines are read from the month layout; status
    and day filters become partition filters plus pushed column filters."""

    def __init__(self, base: Shop, orders_path: str, items_path: str, tz: str = tu.REPORT_TZ):
        spark = base.spark
        self.tz = tz
        month = StructField("order_month", StringType())
        orders = spark.read.schema(StructType(list(ORDERS.fields) + [month])).parquet(orders_path)
        items = spark.read.schema(StructType(list(ORDER_ITEMS.fields) + [month])).parquet(items_path)
        super().__init__(
            customers=base.customers,
            categories=base.categories,
            products=base.products,
            orders=orders.select(*[c for c in orders.columns if c != "order_month"]),
            order_items=items.select(*[c for c in items.columns if c != "order_month"]),
        )
        self._orders = orders
        self._items = items

    @staticmethod
    def _months(first_day: dt.date, end_day: dt.date) -> list[str]:
        return sorted(
            {
                tu.month_start(first_day + dt.timedelta(days=i)).strftime("%Y-%m")
                for i in range(max((end_day - first_day).days, 0))
            }
        )

    def completed_orders_between(self, first_day: dt.date, end_day: dt.date, tz: str = tu.REPORT_TZ) -> DataFrame:
        months = F.col("order_month").cast("string").isin(self._months(first_day, end_day))
        o = self._orders.filter(months).drop("order_month")
        return o.filter((F.col("status") == "completed") & tu.instant_range("order_date", first_day, end_day, tz))

    def items_for_days(self, first_day: dt.date, end_day: dt.date) -> DataFrame:
        months = self._months(first_day, end_day)
        return self._items.filter(F.col("order_month").cast("string").isin(months)).drop("order_month")


def lay_out_by_month(shop: Shop, root: str, tz: str = tu.REPORT_TZ) -> MonthLayoutShop:
    orders_path, items_path = f"{root.rstrip('/')}/orders", f"{root.rstrip('/')}/order_items"
    write_orders_by_month(shop, orders_path, tz)
    write_order_items_by_month(shop, items_path, tz)
    return MonthLayoutShop(shop, orders_path, items_path, tz)


LINES_PER_BUCKET = 2_000_000


class OrderLayoutShop(Shop):
    """A shop whose orders and lines lie in the same buckets of the order id, so
    that joining them moves neither."""

    def __init__(self, base: Shop, orders: DataFrame, items: DataFrame):
        super().__init__(base.customers, base.categories, base.products, orders, items)


def lay_out_by_order(shop: Shop, buckets: int | None = None) -> OrderLayoutShop:
    """Orders and lines written once, bucketed by order id under the shared
    folder.  The buckets follow the lines (``LINES_PER_BUCKET``) unless given.
    The rows are dealt by the id first, so a bucket is one file."""
    if buckets is None:
        spark = shop.orders.sparkSession
        buckets = max(least_buckets(spark), 1 + shop.order_items.count() // LINES_PER_BUCKET)
    orders = write_bucketed(shop.orders.repartition(buckets, "id"), "id", buckets, "orders")
    items = write_bucketed(shop.order_items.repartition(buckets, "order_id"), "order_id", buckets, "order_items")
    return OrderLayoutShop(shop, orders, items)
