"""Tiny in-memory shops for boundary tests (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from kassa.sources import model

D = Decimal
T0 = dt.datetime(2020, 1, 1)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_shop(spark, *, customers=None, categories=None, products=None, orders=None, items=None) -> model.Shop:
    """Rows may omit trailing columns that have defaults:
    customers (id, email?, name?, country?, created_at?)
    categories (id, name, parent_id?)
    products (id, category_id?, stock_quantity?, name?, price?, is_active?)
    orders (id, customer_id, order_date, status?, total_amount?, updated_at?)
    items (order_id, product_id, quantity?, unit_price?)
    """
    cust = []
    ids = {o[1] for o in (orders or [])}
    for r in customers or [(i,) for i in sorted(ids)]:
        r = tuple(r) + (None,) * (5 - len(r))
        cid = r[0]
        cust.append(
            (cid, r[1] or f"c{cid}@example.com", r[2] or f"Customer {cid}", r[3], r[4] or T0)
        )
    cats = [tuple(r) + (None,) * (3 - len(r)) for r in (categories or [])]
    prods = []
    for r in products or []:
        r = tuple(r) + (None,) * (6 - len(r))
        pid, cat, stock, name, price, active = r
        prods.append(
            (pid, name or f"Product {pid}", cat, price if price is not None else D("1.00"),
             stock if stock is not None else 0, True if active is None else active, T0)
        )
    ords = []
    for r in orders or []:
        r = tuple(r) + (None,) * (6 - len(r))
        oid, cid, when, status, total, upd = r
        when = ts(when) if isinstance(when, str) else when
        upd = ts(upd) if isinstance(upd, str) else upd
        ords.append((oid, cid, when, status or "completed", total if total is not None else D("10.00"), upd or when))
    its = []
    for n, r in enumerate(items or []):
        r = tuple(r) + (None,) * (4 - len(r))
        oid, pid, qty, price = r
        its.append((n + 1, oid, pid, qty or 1, price if price is not None else D("1.00")))
    mk = lambda rows, schema: spark.createDataFrame(rows, schema)
    return model.Shop(
        customers=mk(cust, model.CUSTOMERS),
        categories=mk(cats, model.CATEGORIES),
        products=mk(prods, model.PRODUCTS),
        orders=mk(ords, model.ORDERS),
        order_items=mk(its, model.ORDER_ITEMS),
    )


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
