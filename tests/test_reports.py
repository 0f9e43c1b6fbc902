"""Boundary fixtures with hand-computed answers (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import D, make_shop, rows
from kassa.operators import adhoc, cohort, daily_summary, inventory, patterns, product, quality, rfm, shared, trend


def test_jakarta_edge(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-11-28 17:00:00"), (2, 1, "2024-11-28 16:59:59")])
    got = sorted(rows(shared.daily_sales(s, dt.date(2024, 11, 27), dt.date(2024, 11, 30)), "day", "total_orders"))
    assert got == [(dt.date(2024, 11, 28), 1), (dt.date(2024, 11, 29), 1)]


COHORT_COLS = ("cohort_month", "new_customers", "running_total_customers", "retained_customers",
               "retention_rate_pct", "new_customers_change")


def test_cohort_history(spark):
    s = make_shop(spark, orders=[
        (1, 1, "2023-12-10 00:00:00"), (2, 1, "2024-03-10 00:00:00"),
        (3, 2, "2024-12-10 00:00:00"), (4, 2, "2025-01-10 00:00:00"),
    ])
    assert rows(cohort.customer_cohort(s, 2024), *COHORT_COLS) == [("2024-12", 1, 1, 1, 100.0, None)]


def test_cohort_status(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-01-10 00:00:00", "cancelled"), (2, 1, "2024-02-10 00:00:00")])
    assert [r[0] for r in rows(cohort.customer_cohort(s, 2024), *COHORT_COLS)] == ["2024-02"]


def test_cohort_gap(spark):
    s = make_shop(spark, orders=[
        (1, 1, "2024-01-05 00:00:00"), (2, 2, "2024-01-06 00:00:00"), (3, 3, "2024-01-07 00:00:00"),
        (4, 4, "2024-04-05 00:00:00"),
    ])
    got = rows(cohort.customer_cohort(s, 2024), "cohort_month", "new_customers", "running_total_customers",
               "new_customers_change")
    assert got == [("2024-01", 3, 3, None), ("2024-04", 1, 4, -2)]


def _product_shop(spark, revenues, category=2, extra_products=(), as_day="2024-01-10 00:00:00"):
    cats = [(1, "Parent", None), (2, "Cat", 1)]
    products = [(i + 1, category) for i in range(len(revenues))] + list(extra_products)
    orders = [(i + 1, 1, as_day) for i in range(len(revenues))]
    items = [(i + 1, i + 1, 1, D(str(r))) for i, r in enumerate(revenues)]
    return make_shop(spark, categories=cats, products=products, orders=orders, items=items)


PP = ("product_id", "category", "parent_category", "category_revenue_rank", "category_revenue_share_pct",
      "is_top_20_pct_in_category")


def test_product_tie(spark):
    s = _product_shop(spark, [100, 100, 50])
    got = rows(product.product_performance(s, as_of=dt.date(2024, 3, 1)), *PP)
    assert got == [
        (1, "Cat", "Parent", 1, 40.0, True),
        (2, "Cat", "Parent", 1, 40.0, True),
        (3, "Cat", "Parent", 3, 20.0, False),
    ]


def test_product_single(spark):
    s = _product_shop(spark, [70])
    assert rows(product.product_performance(s, as_of=dt.date(2024, 3, 1)), *PP) == [
        (1, "Cat", "Parent", 1, 100.0, True)
    ]


def test_product_null_category(spark):
    s = _product_shop(spark, [30, 20], category=None)
    got = rows(product.product_performance(s, as_of=dt.date(2024, 3, 1)), *PP)
    assert got == [
        (1, "Uncategorized", "Uncategorized", 1, 60.0, True),
        (2, "Uncategorized", "Uncategorized", 2, 40.0, False),
    ]


def test_product_mom(spark):
    s = make_shop(
        spark,
        categories=[(1, "Cat")],
        products=[(1, 1), (2, 1)],
        orders=[(1, 1, "2024-02-10 00:00:00"), (2, 1, "2024-01-10 00:00:00"), (3, 1, "2024-02-11 00:00:00")],
        items=[(1, 1, 1, D("150")), (2, 1, 1, D("100")), (3, 2, 1, D("150"))],
    )
    got = rows(product.product_performance(s, as_of=dt.date(2024, 3, 15)), "product_id", "last_month",
               "last_month_revenue", "prev_month_revenue", "mom_revenue_change", "mom_revenue_change_pct")
    assert sorted(got) == [(1, "2024-02", 150.0, 100.0, 50.0, 50.0), (2, "2024-02", 150.0, 0.0, 150.0, None)]


AS_OF = dt.date(2024, 12, 31)


def test_rfm_bands(spark):
    recencies = [30, 31, 90, 91, 180, 181, 365, 366]
    orders = [(i + 1, i + 1, dt.datetime.combine(AS_OF - dt.timedelta(days=r), dt.time())) for i, r in enumerate(recencies)]
    got = sorted(rows(rfm.rfm_segmentation(make_shop(spark, orders=orders), as_of=AS_OF), "customer_id", "recency_days", "r_score"))
    assert [(r, s) for _, r, s in got] == list(zip(recencies, [5, 4, 4, 3, 3, 2, 2, 1]))


def test_rfm_frequency(spark):
    counts = [1, 2, 3, 5, 6, 9, 10, 19, 20]
    orders, oid = [], 0
    for cid, n in enumerate(counts, start=1):
        for k in range(n):
            oid += 1
            orders.append((oid, cid, dt.datetime(2024, 1, 1) + dt.timedelta(days=k)))
    got = sorted(rows(rfm.rfm_segmentation(make_shop(spark, orders=orders), as_of=AS_OF), "customer_id", "frequency_count", "f_score"))
    assert [(f, s) for _, f, s in got] == list(zip(counts, [1, 1, 2, 2, 3, 3, 4, 4, 5]))


def test_rfm_ntile(spark):
    orders = [(i, i, "2024-12-01 00:00:00", "completed", D(i)) for i in range(1, 8)]
    got = sorted(rows(rfm.rfm_segmentation(make_shop(spark, orders=orders), as_of=AS_OF), "customer_id", "m_score"))
    assert [m for _, m in got] == [1, 1, 2, 2, 3, 4, 5]


def test_rfm_segments(spark):
    df = spark.createDataFrame([(t,) for t in [3, 5, 6, 8, 9, 11, 12, 15]], "t int")
    seg = rfm._bands(F.col("t"), rfm.SEGMENTS, lambda c, b: c >= b, rfm.OTHER_SEGMENT)
    assert [r[0] for r in df.select(seg).collect()] == ["Lost", "Lost", "At Risk", "At Risk", "Loyal", "Loyal",
                                                        "Champions", "Champions"]


TR = ("day", "total_orders", "revenue", "revenue_7d_avg", "revenue_vs_avg_pct", "anomaly_flag")


def test_trend_empty(spark):
    s = make_shop(spark, orders=[(1, 1, "2020-01-01 00:00:00")])
    got = rows(trend.sales_trend(s, 3, as_of=dt.date(2024, 1, 10)), *TR)
    assert got == [(dt.date(2024, 1, d), 0, 0.0, 0.0, None, "Normal") for d in (7, 8, 9)]


def _trend_shop(spark, values, last_day=dt.date(2024, 1, 10)):
    first = last_day - dt.timedelta(days=len(values) - 1)
    orders = [
        (i + 1, 1, dt.datetime.combine(first + dt.timedelta(days=i), dt.time()), "completed", D(v))
        for i, v in enumerate(values)
    ]
    return make_shop(spark, orders=orders), last_day + dt.timedelta(days=1)


def test_trend_spike(spark):
    s, as_of = _trend_shop(spark, ["100.00"] * 6 + ["200.00"])
    assert rows(trend.sales_trend(s, 1, as_of=as_of), *TR) == [(dt.date(2024, 1, 10), 1, 200.0, 114.29, 75.0, "Spike")]


@pytest.mark.parametrize("last,pct,flag", [("26.00", 30.0, "Normal"), ("26.01", 30.04, "Spike")])
def test_trend_edge(spark, last, pct, flag):
    s, as_of = _trend_shop(spark, ["19.00"] * 6 + [last])
    got = rows(trend.sales_trend(s, 1, as_of=as_of), "revenue_7d_avg", "revenue_vs_avg_pct", "anomaly_flag")
    assert got == [(20.0, pct, flag)]


INV_AS_OF = dt.date(2024, 6, 1)


def _stock_shop(spark, stocks_units):
    products = [(i + 1, None, stock) for i, (stock, _) in enumerate(stocks_units)]
    orders, items = [], []
    for i, (_, units) in enumerate(stocks_units):
        if units:
            orders.append((i + 1, 1, "2024-05-01 00:00:00"))
            items.append((i + 1, i + 1, units))
    return make_shop(spark, customers=[(1,)], products=products, orders=orders, items=items)


def test_stock_bands(spark):
    stocks = [0, 6, 7, 29, 30, 90, 91]
    s = _stock_shop(spark, [(st, 90) for st in stocks])
    got = sorted(rows(inventory.inventory_turnover(s, 90, as_of=INV_AS_OF), "product_id", "stock_status"))
    assert [g[1] for g in got] == ["Critical", "Critical", "Low", "Low", "Adequate", "Adequate", "Overstocked"]


def test_stock_dead(spark):
    s = _stock_shop(spark, [(5, 0), (0, 0)])
    got = rows(inventory.inventory_turnover(s, 90, as_of=INV_AS_OF), "product_id", "stock_status",
               "days_until_stockout", "reorder_quantity")
    assert got == [(1, "Dead Stock", None, 0)]


def test_stock_reorder(spark):
    s = _stock_shop(spark, [(0, 6)])
    got = rows(inventory.inventory_turnover(s, 90, as_of=INV_AS_OF), "reorder_quantity", "daily_sales_rate")
    assert got == [(3, 0.07)]


PT = ("customer_id", "total_orders", "avg_days_between_orders", "stddev_days_between_orders",
      "spending_trend", "lifetime_days", "most_purchased_category")


def test_pattern_three(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-03-01 00:00:00"), (2, 1, "2024-03-03 00:00:00"),
                                 (3, 1, "2024-03-07 00:00:00")])
    assert rows(patterns.purchase_patterns(s, 2024), *PT) == [(1, 3, 3.0, 1.4, "Decreasing", 6, None)]


def test_pattern_min(spark):
    s = make_shop(spark, orders=[
        (1, 1, "2024-03-01 00:00:00"), (2, 1, "2024-04-01 00:00:00"),
        (3, 2, "2023-03-01 00:00:00"), (4, 2, "2024-03-01 00:00:00"), (5, 2, "2024-05-01 00:00:00"),
    ])
    assert [(r[0], r[1]) for r in rows(patterns.purchase_patterns(s, 2024), *PT)] == [(2, 3)]


def _lines_shop(spark, lines):
    cats = [(1, "A"), (2, "B")]
    products = [(1, 1), (2, 2)]
    orders = [(1, 1, "2024-03-01 00:00:00"), (2, 1, "2024-03-02 00:00:00"), (3, 1, "2024-03-03 00:00:00")]
    return make_shop(spark, categories=cats, products=products, orders=orders, items=lines)


def test_pattern_tie(spark):
    s = _lines_shop(spark, [(1, 1), (2, 2)])
    assert rows(patterns.purchase_patterns(s, 2024), "most_purchased_category") == [("A, B",)]


def test_pattern_lines(spark):
    s = _lines_shop(spark, [(1, 1, 9), (2, 2, 1), (3, 2, 1)])
    assert rows(patterns.purchase_patterns(s, 2024), "most_purchased_category") == [("B",)]


SUM = ("total_orders", "total_revenue", "average_order_value", "top_category")


def test_summary_empty(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-01-01 00:00:00")])
    assert rows(daily_summary.daily_sales_summary(s, dt.date(2024, 11, 29)), *SUM) == [(0, "0.00", "0.00", None)]


def test_summary_tie(spark):
    s = make_shop(
        spark,
        categories=[(1, "Zeta"), (2, "Alpha")],
        products=[(1, 1), (2, 2)],
        orders=[(1, 1, "2024-11-29 03:00:00", "completed", D("125000.50")), (2, 2, "2024-11-29 04:00:00")],
        items=[(1, 1, 1, D("5")), (2, 2, 1, D("5"))],
    )
    got = rows(daily_summary.daily_sales_summary(s, dt.date(2024, 11, 29)), *SUM)
    assert got == [(2, "125010.50", "62505.25", "Alpha")]


def test_frequent_edge(spark):
    orders = [(i, 1, "2024-02-01 00:00:00") for i in range(1, 6)]
    orders += [(i, 2, "2024-02-01 00:00:00") for i in range(6, 12)]
    s = make_shop(spark, orders=orders)
    since = dt.date(2024, 1, 1)
    for fn in (adhoc.frequent_customers_join_first, adhoc.frequent_customers_agg_first):
        assert rows(fn(s, since), "email", "order_count") == [("c2@example.com", 6)]
    assert adhoc.frequent_customers_diff(s, since).count() == 0


def test_dq_cases(spark):
    s = make_shop(
        spark,
        customers=[(1, "a"), (2, "x@example.com", None, "id"), (3, "Dup@Example.com"), (4, "dup@example.com")],
        products=[(1, None)],
        orders=[(1, 1, "2024-01-01 00:00:00", "Completed")],
        items=[(1, 99)],
    )
    assert rows(quality.dq_email_format(s), "id") == [(1,)]
    assert rows(quality.dq_country_format(s), "id", "country") == [(2, "id")]
    assert rows(quality.dq_order_status(s), "id", "status") == [(1, "Completed")]
    assert rows(quality.dq_email_duplicates(s), "email_key", "row_count") == [("dup@example.com", 2)]
    assert rows(quality.dq_orphans(s), "rule", "key") == [("order_items.product_id", 99)]
