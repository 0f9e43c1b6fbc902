"""A shop with faults: the driver's shop as a loose export would hold it.

Every fault is keyed off the row's own key, so the work and the number of
violations grow with the tables.  The data-quality checks run over it (and
find nothing over the clean shop).  Faults, by ``id % m = r``:

  customers    email without '@' (97, 3), email shared in two spellings with the
               next id (101, 5 and 6), no name (211, 0), country in lower case
               with a digit (83, 2)
  categories   the parent does not exist (7, 0), listed twice (10, 0)
  products     negative price (61, 0), stock -1 (67, 0), unknown category (71, 0),
               no name (73, 0)
  orders       no status (53, 0), 'Completed' (59, 0), negative total (103, 0),
               unknown customer (107, 0)
  order_items  quantity 0 (109, 0), negative unit price (113, 0), unknown order
               (127, 0), unknown product (131, 0)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.sources.model import Shop


def _hit(m: int, r: int = 0) -> Column:
    return F.col("id") % m == r


def _faulty(df: DataFrame, faults: dict[str, list[tuple[Column, Column]]]) -> DataFrame:
    """``faults``: column -> (where, value); the first that holds counts."""
    out = []
    for f in df.schema.fields:
        value = F.col(f.name)
        for where, wrong in reversed(faults.get(f.name, [])):
            value = F.when(where, wrong.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return df.select(*out)


def dirty_shop(shop: Shop) -> Shop:
    key = F.col("id")
    none = F.lit(None)
    pair = F.floor(key / 101).cast("string")
    customers = _faulty(
        shop.customers,
        {
            "email": [
                (_hit(97, 3), F.lit("unknown")),
                (_hit(101, 5), F.concat(F.lit("pair"), pair, F.lit("@example.com"))),
                (_hit(101, 6), F.concat(F.lit("Pair"), pair, F.lit("@Example.com"))),
            ],
            "name": [(_hit(211), none)],
            "country": [(_hit(83, 2), F.concat(F.lower(F.coalesce("country", F.lit("xx"))), F.lit("1")))],
        },
    )
    categories = _faulty(shop.categories, {"parent_id": [(F.col("parent_id").isNotNull() & _hit(7), F.lit(-1))]})
    categories = categories.unionByName(categories.where(_hit(10)).withColumn("id", -key))
    products = _faulty(
        shop.products,
        {
            "price": [(_hit(61), -F.col("price"))],
            "stock_quantity": [(_hit(67), F.lit(-1))],
            "category_id": [(_hit(71), F.lit(-5))],
            "name": [(_hit(73), none)],
        },
    )
    orders = _faulty(
        shop.orders,
        {
            "status": [(_hit(53), none), (_hit(59), F.lit("Completed"))],
            "total_amount": [(_hit(103), -F.col("total_amount"))],
            "customer_id": [(_hit(107), -F.col("customer_id"))],
        },
    )
    items = _faulty(
        shop.order_items,
        {
            "quantity": [(_hit(109), F.lit(0))],
            "unit_price": [(_hit(113), -F.col("unit_price"))],
            "order_id": [(_hit(127), -F.col("order_id"))],
            "product_id": [(_hit(131), -F.col("product_id"))],
        },
    )
    return Shop(customers, categories, products, orders, items)
