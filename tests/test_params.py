import datetime as dt

import pytest

from fixtures import make_shop, rows
from kassa.plans.params import MAX_DAYS, ReportParams, parse_type, run_report

DAY = dt.date(2024, 11, 29)


@pytest.mark.parametrize("report", ["customer_cohort", "purchase_patterns"])
def test_years_from_2000_to_2100(report):
    for year in (2000, 2050, 2100):
        ReportParams(report, year=year).validate()
    for year in (1999, 2101, -5):
        with pytest.raises(ValueError, match="year"):
            ReportParams(report, year=year).validate()


@pytest.mark.parametrize("report", ["sales_trend", "inventory_turnover"])
def test_days_from_1_to_730(report):
    for days in (1, 365, MAX_DAYS):
        ReportParams(report, days=days).validate()
    for days in (-1, 0, MAX_DAYS + 1):
        with pytest.raises(ValueError, match="days"):
            ReportParams(report, days=days).validate()


def test_limits_bind_only_where_they_are_used():
    ReportParams("product_performance", year=0, days=10**6).validate()
    ReportParams("daily_sales_summary", day=DAY, limit=0).validate()
    with pytest.raises(ValueError, match="date is required"):
        ReportParams("daily_sales_summary", year=2020, days=7).validate()
    with pytest.raises(ValueError, match="limit"):
        ReportParams("product_performance", limit=-3).validate()
    with pytest.raises(ValueError, match="unknown report type"):
        ReportParams("weekly_totals").validate()


def test_parse_type_lists_valid_types():
    with pytest.raises(ValueError, match="customer_cohort"):
        parse_type("nope")
    assert parse_type(" Sales_Trend ") == "sales_trend"


def test_run_report_applies_limit_after_sort(spark):
    s = make_shop(spark, orders=[(i, i, f"2024-11-{i:02d} 00:00:00") for i in range(1, 11)])
    df = run_report(s, ReportParams("sales_trend", days=10, limit=3), as_of=dt.date(2024, 11, 11))
    assert [r[0] for r in rows(df, "day")] == [dt.date(2024, 11, 1), dt.date(2024, 11, 2), dt.date(2024, 11, 3)]
