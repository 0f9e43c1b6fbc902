"""Report parameters: type names, limits and a dispatcher.

``run_report`` validates the parameters, runs the report against a shop with
an explicit ``as_of`` day and applies the row limit after the report's sort.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kassa.functions import timeutil as tu
from kassa.sinks.outputs import report_head
from kassa.sources.model import Shop

# Report types, parameter limits and defaults.
REPORT_TYPES = (
    "customer_cohort",
    "product_performance",
    "rfm_segmentation",
    "sales_trend",
    "inventory_turnover",
    "purchase_patterns",
    "daily_sales_summary",
)
MIN_YEAR, MAX_YEAR = 2000, 2100
MIN_DAYS, MAX_DAYS = 1, 730
DEFAULT_YEAR, DEFAULT_DAYS = 2024, 90
USES_YEAR = {"customer_cohort", "purchase_patterns"}
USES_DAYS = {"sales_trend", "inventory_turnover"}
USES_DAY = {"daily_sales_summary"}


def parse_type(name: str) -> str:
    t = name.strip().lower()
    if t not in REPORT_TYPES:
        raise ValueError(f"unknown report type {name!r}: expected one of {', '.join(REPORT_TYPES)}")
    return t


@dataclass(frozen=True)
class ReportParams:
    type: str
    year: int = DEFAULT_YEAR
    days: int = DEFAULT_DAYS
    day: dt.date | None = None
    limit: int | None = None

    def validate(self) -> None:
        parse_type(self.type)
        if self.type in USES_YEAR and not MIN_YEAR <= self.year <= MAX_YEAR:
            raise ValueError(f"year must be in {MIN_YEAR}..{MAX_YEAR}, got {self.year}")
        if self.type in USES_DAYS and not MIN_DAYS <= self.days <= MAX_DAYS:
            raise ValueError(f"days must be in {MIN_DAYS}..{MAX_DAYS}, got {self.days}")
        if self.type in USES_DAY and self.day is None:
            raise ValueError("date is required for daily_sales_summary")
        if self.limit is not None and self.limit < 0:
            raise ValueError(f"limit must be >= 0, got {self.limit}")


def run_report(shop: Shop, p: ReportParams, *, as_of: dt.date | None = None, tz: str = tu.REPORT_TZ) -> DataFrame:
    """The report named by ``p`` as a DataFrame (no action runs here beyond
    the documented numbering summaries)."""
    from kassa.operators import cohort, daily_summary, inventory, patterns, product, rfm, trend

    p.validate()
    if as_of is None:
        as_of = tu.yesterday_in(dt.datetime.now(dt.timezone.utc), tz) + dt.timedelta(days=1)
    builders = {
        "customer_cohort": lambda: cohort.customer_cohort(shop, p.year, tz=tz),
        "product_performance": lambda: product.product_performance(shop, as_of=as_of, tz=tz),
        "rfm_segmentation": lambda: rfm.rfm_segmentation(shop, as_of=as_of, tz=tz),
        "sales_trend": lambda: trend.sales_trend(shop, p.days, as_of=as_of, tz=tz),
        "inventory_turnover": lambda: inventory.inventory_turnover(shop, p.days, as_of=as_of, tz=tz),
        "purchase_patterns": lambda: patterns.purchase_patterns(shop, p.year, tz=tz),
        "daily_sales_summary": lambda: daily_summary.daily_sales_summary(shop, p.day, tz),
    }
    return report_head(builders[p.type](), p.limit or None)
