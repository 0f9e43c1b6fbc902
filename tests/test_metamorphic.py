"""Metamorphic checks on the driver's sf0.01 tables (SURVEY §5 (c))."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01
from kassa.operators import rfm, shared, trend
from kassa.plans.catalog import AS_OF, REFRESH_SINCE, shop


def test_trend_total_equals_daily_sales(spark):
    s = shop(spark, SF01)
    t = trend.sales_trend(s, 90, as_of=AS_OF).agg(F.sum("total_orders"), F.round(F.sum("revenue"), 2)).first()
    d = shared.daily_sales(s, AS_OF - dt.timedelta(days=90), AS_OF).agg(
        F.sum("total_orders"), F.round(F.sum("revenue").cast("double"), 2)
    ).first()
    assert tuple(t) == tuple(d)


def _quintile_sizes(df):
    return [r[1] for r in df.groupBy("m_score").count().orderBy("m_score").collect()]


def test_quintile_sizes_differ_by_at_most_one(spark):
    s = shop(spark, SF01)
    sizes = _quintile_sizes(rfm.rfm_segmentation(s, as_of=AS_OF))
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_refresh_equals_full_summary(spark):
    s = shop(spark, SF01)
    got = shared.refresh_customer_monthly_summary(s, shared.summary_before(s, REFRESH_SINCE), REFRESH_SINCE)
    full = shared.customer_monthly_summary(s)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_clean_shop_has_no_violations_and_dirty_one_has(spark):
    from kassa.operators import quality
    from kassa.sources.dirty import dirty_shop

    clean = shop(spark, SF01)
    dirty = dirty_shop(clean)
    checks = (
        "dq_email_format", "dq_country_format", "dq_email_duplicates",
        "dq_category_name_duplicates", "dq_order_status", "dq_orphans",
    )
    for name in checks:
        check = getattr(quality, name)
        assert check(clean).count() == 0 < check(dirty).count(), name
    for name, column in (("dq_nulls", "null_count"), ("dq_ranges", "violations")):
        check = getattr(quality, name)
        assert check(clean).where(f"{column} > 0").count() == 0 < check(dirty).where(f"{column} > 0").count(), name
