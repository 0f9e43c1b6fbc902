"""Data-quality checks: the constraints a database would enforce, returned
as violations or counts.  Each table is read once per check; counts use
conditional aggregates (one pass), references use left-anti joins (the
dimension side is small and Spark broadcasts it when its measured size
allows, otherwise it shuffles both sides).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kassa.sources.model import STATUSES, Shop

# Required (NOT NULL) columns of the model, per table.
REQUIRED = {
    "customers": ["id", "email", "name", "created_at"],
    "categories": ["id", "name"],
    "products": ["id", "name", "price", "stock_quantity", "is_active", "created_at"],
    "orders": ["id", "customer_id", "order_date", "status", "total_amount", "updated_at"],
    "order_items": ["id", "order_id", "product_id", "quantity", "unit_price"],
}
EMAIL_PATTERN = "%_@_%"
COUNTRY_PATTERN = "^[A-Z]{2}$"


def _tables(shop: Shop) -> dict[str, DataFrame]:
    return {
        "customers": shop.customers,
        "categories": shop.categories,
        "products": shop.products,
        "orders": shop.orders,
        "order_items": shop.order_items,
    }


def dq_nulls(shop: Shop) -> DataFrame:
    """(table_name, column_name, null_count) for every required column."""
    parts = []
    for table, df in _tables(shop).items():
        cols = REQUIRED[table]
        counts = df.agg(
            *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols]
        )
        parts.append(
            counts.unpivot([], cols, "column_name", "null_count").select(
                F.lit(table).alias("table_name"),
                "column_name",
                F.col("null_count").cast(LongType()).alias("null_count"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_email_format(shop: Shop) -> DataFrame:
    return shop.customers.filter(~F.col("email").like(EMAIL_PATTERN)).select("id", "email")


def dq_country_format(shop: Shop) -> DataFrame:
    return shop.customers.filter(
        F.col("country").isNotNull() & ~F.col("country").rlike(COUNTRY_PATTERN)
    ).select("id", "country")


def dq_email_duplicates(shop: Shop) -> DataFrame:
    return (
        shop.customers.groupBy(F.lower("email").alias("email_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def dq_category_name_duplicates(shop: Shop) -> DataFrame:
    return (
        shop.categories.groupBy("name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def dq_order_status(shop: Shop) -> DataFrame:
    """Orders whose status is NULL or not one of the three values (so
    'Completed' and 'complete' are reported too)."""
    s = F.col("status")
    return shop.orders.filter(s.isNull() | ~s.isin(*STATUSES)).select("id", "status")


# Fixed values: (rule, table, violation predicate) of the range constraints.
RANGE_RULES = [
    ("products.price >= 0", "products", lambda: F.col("price") < 0),
    ("products.stock_quantity >= 0", "products", lambda: F.col("stock_quantity") < 0),
    ("orders.total_amount >= 0", "orders", lambda: F.col("total_amount") < 0),
    ("order_items.quantity > 0", "order_items", lambda: F.col("quantity") <= 0),
    ("order_items.unit_price >= 0", "order_items", lambda: F.col("unit_price") < 0),
]


def dq_ranges(shop: Shop) -> DataFrame:
    """(rule, violations): one conditional-count pass per table."""
    tables = _tables(shop)
    parts = []
    for table in dict.fromkeys(t for _, t, _ in RANGE_RULES):
        rules = [(i, rule, pred) for i, (rule, t, pred) in enumerate(RANGE_RULES) if t == table]
        counts = tables[table].agg(*[F.count(F.when(pred(), 1)).alias(f"r{i}") for i, _, pred in rules])
        names = F.create_map(*[x for i, rule, _ in rules for x in (F.lit(f"r{i}"), F.lit(rule))])
        parts.append(
            counts.unpivot([], [f"r{i}" for i, _, _ in rules], "_key", "violations").select(
                names[F.col("_key")].alias("rule"), F.col("violations").cast(LongType()).alias("violations")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_orphans(shop: Shop) -> DataFrame:
    """(rule, key) for every reference that does not resolve."""

    def anti(child: DataFrame, fk: str, parent: DataFrame, rule: str) -> DataFrame:
        keys = parent.select(F.col("id").alias("_ref"))
        return (
            child.filter(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("_ref"), "left_anti")
            .select(F.lit(rule).alias("rule"), F.col(fk).cast(LongType()).alias("key"))
        )

    return (
        anti(shop.categories, "parent_id", shop.categories, "categories.parent_id")
        .unionByName(anti(shop.products, "category_id", shop.categories, "products.category_id"))
        .unionByName(anti(shop.orders, "customer_id", shop.customers, "orders.customer_id"))
        .unionByName(anti(shop.order_items, "order_id", shop.orders, "order_items.order_id"))
        .unionByName(anti(shop.order_items, "product_id", shop.products, "order_items.product_id"))
    )


def dq_item_duplicates(shop: Shop) -> DataFrame:
    return (
        shop.order_items.groupBy("order_id", "product_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def order_total_reconcile(shop: Shop) -> DataFrame:
    """Orders whose stored total differs from the sum of their lines
    (an order without lines counts as 0)."""
    lines = shop.order_items.groupBy("order_id").agg(
        F.sum(F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).alias("items_total")
    )
    o = shop.orders.select(F.col("id").alias("order_id"), "total_amount")
    j = o.join(lines, "order_id", "left").select(
        "order_id",
        "total_amount",
        F.coalesce("items_total", F.lit(0).cast("decimal(38,2)")).alias("items_total"),
    )
    return j.filter(F.col("total_amount") != F.col("items_total")).select(
        "order_id",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("items_total").cast("double").alias("items_total"),
        (F.col("total_amount") - F.col("items_total")).cast("double").alias("difference"),
    )


def table_row_counts(shop: Shop) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).cast(LongType()).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in _tables(shop).items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
