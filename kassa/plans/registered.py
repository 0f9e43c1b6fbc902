"""The registered queries, each over the whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kassa.functions.money import money
from kassa.operators import (
    adhoc,
    cohort,
    daily_summary,
    generate,
    inventory,
    normalise,
    patterns,
    product,
    quality,
    rfm,
    shared,
    summary_table,
    trend,
)
from kassa.plans.catalog import (
    AS_OF,
    DAYS,
    EVENTS_AS_OF,
    LOOKUP_EMAIL,
    LOOKUP_ID,
    REFRESH_SINCE,
    SINCE,
    SUMMARY_DAY,
    YEAR,
    events,
    register,
    scratch_path,
    shop,
)
from kassa.sinks import outputs
from kassa.sources import legacy
from kassa.sources.changes import order_changes, orders_before
from kassa.sources.dirty import dirty_shop
from kassa.sources.driver_tables import DriverTables
from kassa.sources.model import ORDERS, STATUS_COMPLETED
from kassa.streaming import streams


@register("sales_trend")
def q_sales_trend(spark, sf_dir):
    return trend.sales_trend(shop(spark, sf_dir), DAYS, as_of=AS_OF)


@register("sales_trend_events")
def q_sales_trend_events(spark, sf_dir):
    """The same report on purchase events, whose times of day move them
    across the Jakarta day boundary."""
    return trend.sales_trend(events(spark, sf_dir), 30, as_of=EVENTS_AS_OF)


@register("daily_sales")
def q_daily_sales(spark, sf_dir):
    s = shop(spark, sf_dir)
    return shared.daily_sales(s, AS_OF.replace(year=AS_OF.year - 1), AS_OF)


@register("daily_sales_events")
def q_daily_sales_events(spark, sf_dir):
    s = events(spark, sf_dir)
    return shared.daily_sales(s, EVENTS_AS_OF.replace(month=1, day=1), EVENTS_AS_OF)


@register("customer_cohort")
def q_customer_cohort(spark, sf_dir):
    return cohort.customer_cohort(shop(spark, sf_dir), YEAR)


@register("product_performance")
def q_product_performance(spark, sf_dir):
    return product.product_performance(shop(spark, sf_dir), as_of=AS_OF)


@register("rfm_segmentation")
def q_rfm_segmentation(spark, sf_dir):
    return rfm.rfm_segmentation(shop(spark, sf_dir), as_of=AS_OF)


@register("inventory_turnover")
def q_inventory_turnover(spark, sf_dir):
    return inventory.inventory_turnover(shop(spark, sf_dir), DAYS, as_of=AS_OF)


@register("purchase_patterns")
def q_purchase_patterns(spark, sf_dir):
    return patterns.purchase_patterns(shop(spark, sf_dir), YEAR)


@register("daily_sales_summary")
def q_daily_sales_summary(spark, sf_dir):
    return daily_summary.daily_sales_summary(shop(spark, sf_dir), SUMMARY_DAY)


@register("low_stock_alerts")
def q_low_stock_alerts(spark, sf_dir):
    return inventory.low_stock_alerts(shop(spark, sf_dir), DAYS, as_of=AS_OF)


@register("churn_risk")
def q_churn_risk(spark, sf_dir):
    return rfm.churn_risk(shop(spark, sf_dir), as_of=AS_OF)


@register("weekly_sales")
def q_weekly_sales(spark, sf_dir):
    return trend.sales_trend(shop(spark, sf_dir), 7, as_of=AS_OF)


@register("monthly_revenue_breakdown")
def q_monthly_revenue_breakdown(spark, sf_dir):
    return product.monthly_revenue_breakdown(shop(spark, sf_dir), as_of=AS_OF)


@register("category_rollup")
def q_category_rollup(spark, sf_dir):
    return shared.category_rollup(shop(spark, sf_dir))


@register("category_tree")
def q_category_tree(spark, sf_dir):
    """Every category with the top of its tree and its depth."""
    return shared.category_tree(shop(spark, sf_dir))


@register("product_sales")
def q_product_sales(spark, sf_dir):
    return shared.product_sales(shop(spark, sf_dir), as_of=AS_OF, window_days=DAYS)


@register("order_sequence")
def q_order_sequence(spark, sf_dir):
    return patterns.order_sequence_report(shop(spark, sf_dir))


@register("customer_monthly_summary")
def q_customer_monthly_summary(spark, sf_dir):
    s = shared.customer_monthly_summary(shop(spark, sf_dir))
    return s.select("customer_id", "order_month", "order_count", money(F.col("revenue")).alias("revenue"))


@register("frequent_customers_join_first")
def q_frequent_join_first(spark, sf_dir):
    return adhoc.frequent_customers_join_first(shop(spark, sf_dir), SINCE)


@register("frequent_customers_agg_first")
def q_frequent_agg_first(spark, sf_dir):
    return adhoc.frequent_customers_agg_first(shop(spark, sf_dir), SINCE)


@register("frequent_customers_top")
def q_frequent_top(spark, sf_dir):
    return adhoc.frequent_customers_top(shop(spark, sf_dir), SINCE)


@register("frequent_customers_diff")
def q_frequent_diff(spark, sf_dir):
    return adhoc.frequent_customers_diff(shop(spark, sf_dir), SINCE)


@register("customer_by_id")
def q_customer_by_id(spark, sf_dir):
    return adhoc.customer_by_id(shop(spark, sf_dir), LOOKUP_ID)


@register("customer_by_email")
def q_customer_by_email(spark, sf_dir):
    return adhoc.customer_by_email(shop(spark, sf_dir), LOOKUP_EMAIL)


def _dq(name, fn):
    register(name)(lambda spark, sf_dir: fn(shop(spark, sf_dir)))


for _name in ("dq_item_duplicates", "order_total_reconcile", "table_row_counts"):
    _dq(_name, getattr(quality, _name))


def _dq_dirty(name, fn):
    """Constraint checks run over the shop with faults: every one finds some."""
    register(name)(lambda spark, sf_dir: fn(dirty_shop(shop(spark, sf_dir))))


for _name in (
    "dq_nulls",
    "dq_email_format",
    "dq_country_format",
    "dq_email_duplicates",
    "dq_category_name_duplicates",
    "dq_order_status",
    "dq_ranges",
    "dq_orphans",
):
    _dq_dirty(_name, getattr(quality, _name))


@register("customer_monthly_summary_refresh")
def q_customer_monthly_summary_refresh(spark, sf_dir):
    """The stored summary as it was before REFRESH_SINCE, refreshed by the change
    records since (moved, re-dated, re-priced, new and deleted orders); equals the
    full recompute."""
    s = shop(spark, sf_dir)
    path = scratch_path(spark, "monthly_table")
    changes = order_changes(s, REFRESH_SINCE)
    before = orders_before(s, changes, REFRESH_SINCE).where(F.col("status") == STATUS_COMPLETED)
    summary_table.write_monthly_table(shared.monthly_summary(before), path)
    summary_table.apply_changes(spark, path, changes, batch=1)
    out = summary_table.read_monthly_table(spark, path)
    return out.select("customer_id", "order_month", "order_count", money(F.col("revenue")).alias("revenue"))


def _order_layout(name, fn):
    """A report over orders and lines that lie in the same buckets."""
    register(name)(lambda spark, sf_dir: fn(shared.lay_out_by_order(shop(spark, sf_dir))))


_order_layout(
    "product_sales_order_layout", lambda s: shared.product_sales(s, as_of=AS_OF, window_days=DAYS)
)
_order_layout("product_performance_order_layout", lambda s: product.product_performance(s, as_of=AS_OF))
_order_layout("inventory_turnover_order_layout", lambda s: inventory.inventory_turnover(s, DAYS, as_of=AS_OF))
_order_layout("monthly_revenue_order_layout", lambda s: product.monthly_revenue_breakdown(s, as_of=AS_OF))
_order_layout("low_stock_alerts_order_layout", lambda s: inventory.low_stock_alerts(s, DAYS, as_of=AS_OF))


@register("orders_by_month")
def q_orders_by_month(spark, sf_dir):
    """Orders written partitioned by local month to the shared folder, read back."""
    path = scratch_path(spark, "orders_by_month")
    shared.write_orders_by_month(shop(spark, sf_dir), path)
    return shared.read_orders_by_month(spark, path)


HEAD_N = 10


@register("report_titles")
def q_report_titles(spark, sf_dir):
    df = product.product_performance(shop(spark, sf_dir), as_of=AS_OF)
    return outputs.report_titles(df, "product_performance")


@register("report_keys")
def q_report_keys(spark, sf_dir):
    df = trend.sales_trend(shop(spark, sf_dir), DAYS, as_of=AS_OF)
    return outputs.report_keys(outputs.report_titles(df, "sales_trend"))


@register("report_csv")
def q_report_csv(spark, sf_dir):
    """The titled sales trend written as CSV, read back as text."""
    df = trend.sales_trend(shop(spark, sf_dir), DAYS, as_of=AS_OF)
    path = scratch_path(spark, "report_csv")
    outputs.report_csv(outputs.report_titles(df, "sales_trend"), path)
    return spark.read.option("header", True).csv(path)


@register("report_json")
def q_report_json(spark, sf_dir):
    """The titled sales trend written as JSON rows, read back."""
    df = trend.sales_trend(shop(spark, sf_dir), DAYS, as_of=AS_OF)
    path = scratch_path(spark, "report_json")
    outputs.report_json(outputs.report_titles(df, "sales_trend"), path, "Sales Trend")
    return spark.read.schema(outputs.report_keys(outputs.report_titles(df, "sales_trend")).schema).json(
        f"{path}/rows"
    )


@register("report_head")
def q_report_head(spark, sf_dir):
    return outputs.report_head(rfm.rfm_segmentation(shop(spark, sf_dir), as_of=AS_OF), HEAD_N)


@register("report_snapshot")
def q_report_snapshot(spark, sf_dir):
    """Sales trend served through a snapshot folder (computed and written on
    the first call, read back while fresh)."""
    root = scratch_path(spark, "snapshots")
    s = shop(spark, sf_dir)
    return outputs.report_snapshot(
        spark, root, "sales_trend", {"days": DAYS}, lambda: trend.sales_trend(s, DAYS, as_of=AS_OF)
    )


@register("report_run_all")
def q_report_run_all(spark, sf_dir):
    """The seven reports and the monthly breakdown in one run over one pass of
    product sales; a report that fails is listed with its error."""
    s = shared.with_product_sales(shop(spark, sf_dir), as_of=AS_OF, window_days=DAYS)
    jobs = {
        "customer_cohort": lambda: cohort.customer_cohort(s, YEAR),
        "product_performance": lambda: product.product_performance(s, as_of=AS_OF),
        "rfm_segmentation": lambda: rfm.rfm_segmentation(s, as_of=AS_OF),
        "sales_trend": lambda: trend.sales_trend(s, DAYS, as_of=AS_OF),
        "inventory_turnover": lambda: inventory.inventory_turnover(s, DAYS, as_of=AS_OF),
        "purchase_patterns": lambda: patterns.purchase_patterns(s, YEAR),
        "daily_sales_summary": lambda: daily_summary.daily_sales_summary(s, SUMMARY_DAY),
        "monthly_revenue_breakdown": lambda: product.monthly_revenue_breakdown(s, as_of=AS_OF),
    }
    root = scratch_path(spark, "all_reports")
    done = outputs.snapshot_many(spark, root, [(name, {}, job) for name, job in jobs.items()])
    return outputs.run_summary(spark, done)


@register("daily_sales_payload")
def q_daily_sales_payload(spark, sf_dir):
    summary = daily_summary.daily_sales_summary(shop(spark, sf_dir), SUMMARY_DAY)
    return outputs.daily_sales_payload(summary, SUMMARY_DAY, generated_at=dt.datetime(2001, 7, 21, 0, 0, 0))


@register("stream_daily_sales")
def q_stream_daily_sales(spark, sf_dir):
    """Purchase events as a file stream (availableNow); every day so far."""
    root = scratch_path(spark, "stream_daily_sales")
    streams.run_daily_sales(
        spark, sf_dir, f"{root}/sink", f"{root}/checkpoint", name_glob="events.parquet"
    )
    return streams.read_daily_sales(spark, f"{root}/sink")


@register("stream_customer_monthly_summary")
def q_stream_customer_monthly_summary(spark, sf_dir):
    """The summary as of REFRESH_SINCE, then the orders changed since arrive
    as a file stream and each batch upserts the touched customers."""
    s = shop(spark, sf_dir)
    root = scratch_path(spark, "stream_summary")
    streams.write_summary_table(shared.summary_before(s, REFRESH_SINCE), f"{root}/table")
    changed = s.orders.filter(F.col("updated_at") >= F.lit(REFRESH_SINCE.isoformat(" ")).cast("timestamp_ntz"))
    changed.write.parquet(f"{root}/changes")
    table = streams.run_customer_monthly_summary(
        spark, s, f"{root}/changes", f"{root}/table", f"{root}/checkpoint", changes_schema=ORDERS
    )
    out = streams.read_summary_table(spark, table)
    return out.select("customer_id", "order_month", "order_count", money(F.col("revenue")).alias("revenue"))


@register("normalise_legacy_orders")
def q_normalise_legacy_orders(spark, sf_dir):
    return normalise.normalise_legacy_orders(legacy.legacy_orders(DriverTables(spark, sf_dir)))


@register("normalise_legacy_rejects")
def q_normalise_legacy_rejects(spark, sf_dir):
    """The rejected orders, set aside in a folder of their own."""
    path = scratch_path(spark, "legacy_orders")
    normalise.set_aside(normalise.normalise_legacy_orders(legacy.legacy_orders(DriverTables(spark, sf_dir))), path)
    return normalise.read_rejects(spark, path)


@register("normalise_legacy_products")
def q_normalise_legacy_products(spark, sf_dir):
    s = shop(spark, sf_dir)
    return normalise.normalise_legacy_products(legacy.legacy_products(s.tables), s.categories)


SEED = 42


@register("gen_product_weights")
def q_gen_product_weights(spark, sf_dir):
    """A popularity weight for every driver product."""
    return generate.gen_product_weights(shop(spark, sf_dir).products, SEED)


@register("gen_orders")
def q_gen_orders(spark, sf_dir):
    """Synthetic order history for every driver customer (scales with them)."""
    return generate.gen_orders(shop(spark, sf_dir).customers, SEED, AS_OF)


@register("gen_order_items")
def q_gen_order_items(spark, sf_dir):
    """Synthetic lines over the driver's products for every driver customer's orders."""
    s = shop(spark, sf_dir)
    orders = generate.gen_orders(s.customers, SEED, AS_OF)
    weights = generate.gen_product_weights(s.products, SEED)
    return generate.gen_order_items(orders, s.products, weights, SEED, AS_OF)


@register("gen_order_totals")
def q_gen_order_totals(spark, sf_dir):
    """Order totals recomputed from the driver's order lines."""
    s = shop(spark, sf_dir)
    return generate.gen_order_totals(s.orders, s.order_items)


@register("gen_stock")
def q_gen_stock(spark, sf_dir):
    """Stock levels drawn from the driver products' 90-day velocity."""
    s = shop(spark, sf_dir)
    return generate.gen_stock(s.products, s.orders, s.order_items, SEED, AS_OF)


@register("daily_sales_summary_month_layout")
def q_daily_sales_summary_month_layout(spark, sf_dir):
    """The daily summary over orders and lines laid out by month: the lines
    scan reads one month folder."""
    laid_out = shared.lay_out_by_month(shop(spark, sf_dir), scratch_path(spark, "month_layout"))
    return daily_summary.daily_sales_summary(laid_out, SUMMARY_DAY)


@register("customer_cohort_from_summary")
def q_customer_cohort_from_summary(spark, sf_dir):
    """Cohorts from the bucketed summary table (written here from the orders,
    as the nightly refresh or the stream would keep it)."""
    s = shop(spark, sf_dir)
    table = f"{scratch_path(spark, 'summary_table')}/table"
    streams.write_summary_table(shared.customer_monthly_summary(s), table)
    return cohort.cohort_from_monthly(streams.read_summary_table(spark, table), YEAR)


@register("frequent_customers_top_from_summary")
def q_frequent_top_from_summary(spark, sf_dir):
    s = shop(spark, sf_dir)
    table = f"{scratch_path(spark, 'summary_table')}/table"
    streams.write_summary_table(shared.customer_monthly_summary(s), table)
    return adhoc.frequent_customers_top_from_summary(s, streams.read_summary_table(spark, table), SINCE)
