"""Output jobs: display titles, machine keys, CSV / JSON files, the report
head, the daily-sales JSON payload and the per-day report snapshot.

Files are written by Spark's committers (a folder of part files per output,
atomically committed); rows are never gathered on the driver.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from kassa.functions import timeutil as tu

# Sheet name and (column title, result column) of each report.
REPORT_SHEETS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "customer_cohort": (
        "Customer Cohorts",
        [
            ("Cohort Month", "cohort_month"),
            ("New Customers", "new_customers"),
            ("First Month Revenue", "first_month_revenue"),
            ("Running Total Customers", "running_total_customers"),
            ("Retained Next Month", "retained_customers"),
            ("Retention Rate %", "retention_rate_pct"),
            ("New Customers Change", "new_customers_change"),
        ],
    ),
    "product_performance": (
        "Product Performance",
        [
            ("Product ID", "product_id"),
            ("Product", "product_name"),
            ("Category", "category"),
            ("Parent Category", "parent_category"),
            ("Total Revenue", "total_revenue"),
            ("Units Sold", "units_sold"),
            ("Category Rank", "category_revenue_rank"),
            ("Category Share %", "category_revenue_share_pct"),
            ("Last Month", "last_month"),
            ("Last Month Revenue", "last_month_revenue"),
            ("Previous Month Revenue", "prev_month_revenue"),
            ("MoM Change", "mom_revenue_change"),
            ("MoM Change %", "mom_revenue_change_pct"),
            ("Top 20% in Category", "is_top_20_pct_in_category"),
        ],
    ),
    "rfm_segmentation": (
        "RFM Segmentation",
        [
            ("Customer ID", "customer_id"),
            ("Name", "name"),
            ("Email", "email"),
            ("Recency Days", "recency_days"),
            ("Frequency", "frequency_count"),
            ("Monetary", "monetary_value"),
            ("R", "r_score"),
            ("F", "f_score"),
            ("M", "m_score"),
            ("RFM Score", "rfm_score"),
            ("Segment", "segment"),
        ],
    ),
    "sales_trend": (
        "Sales Trend",
        [
            ("Day", "day"),
            ("Day of Week", "day_of_week"),
            ("Orders", "total_orders"),
            ("Revenue", "revenue"),
            ("Revenue 7d Avg", "revenue_7d_avg"),
            ("Orders 7d Avg", "orders_7d_avg"),
            ("Revenue vs Avg %", "revenue_vs_avg_pct"),
            ("Anomaly", "anomaly_flag"),
        ],
    ),
    "inventory_turnover": (
        "Inventory Turnover",
        [
            ("Product ID", "product_id"),
            ("Product", "product_name"),
            ("Category", "category"),
            ("Stock", "stock_quantity"),
            ("Units Sold {days}d", "units_sold_90d"),
            ("Daily Sales Rate", "daily_sales_rate"),
            ("Days Until Stock-out", "days_until_stockout"),
            ("Last Order Date", "last_order_date"),
            ("Stock Status", "stock_status"),
            ("Reorder Quantity", "reorder_quantity"),
        ],
    ),
    "purchase_patterns": (
        "Purchase Patterns",
        [
            ("Customer ID", "customer_id"),
            ("Name", "name"),
            ("Email", "email"),
            ("Orders", "total_orders"),
            ("Avg Days Between Orders", "avg_days_between_orders"),
            ("Std Dev Days Between Orders", "stddev_days_between_orders"),
            ("Most Purchased Category", "most_purchased_category"),
            ("Avg Order Value", "avg_order_value"),
            ("Spending Trend", "spending_trend"),
            ("Lifetime Days", "lifetime_days"),
        ],
    ),
    "daily_sales_summary": (
        "Daily Sales Summary",
        [
            ("Date", "date"),
            ("Total Revenue", "total_revenue"),
            ("Total Orders", "total_orders"),
            ("Average Order Value", "average_order_value"),
            ("Top Category", "top_category"),
        ],
    ),
}
DAILY_SALES_REPORT_TYPE = "daily_sales"
SNAPSHOT_VERSION = "1"
DEFAULT_TTL = dt.timedelta(minutes=10)


def report_key(title: str) -> str:
    """Column title -> machine key: '%' reads as 'pct', every run of other
    characters becomes one '_', letters are lower-cased."""
    words = re.findall(r"[^\W_]+", title.replace("%", " pct "))
    return "_".join(w.lower() for w in words)


def sheet(report: str, days: int = 90) -> tuple[str, list[str], list[str]]:
    name, cols = REPORT_SHEETS[report]
    titles = [t.format(days=days) for t, _ in cols]
    return name, titles, [c for _, c in cols]


def report_titles(df: DataFrame, report: str, days: int = 90) -> DataFrame:
    """Result columns renamed to their display titles; flags as Yes/No."""
    _, titles, cols = sheet(report, days)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for title, c in zip(titles, cols):
        col = F.col(c)
        if isinstance(types[c], BooleanType):
            col = F.when(col, F.lit("Yes")).otherwise(F.lit("No"))
        out.append(col.alias(title))
    return df.select(out)


def report_keys(df: DataFrame) -> DataFrame:
    """Titled columns -> machine keys."""
    return df.toDF(*[report_key(c) for c in df.columns])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as the text the exports show: numbers with fractions to
    two decimals, dates and times as ISO days, NULL stays NULL."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (DoubleType, FloatType)):
            c = F.when(c.isNotNull(), F.format_string("%.2f", c))
        elif isinstance(t, DecimalType):
            c = F.round(c, 2).cast(DecimalType(38, 2)).cast(StringType())
        elif isinstance(t, (DateType, TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, BooleanType):
            c = F.when(c, F.lit("true")).when(~c, F.lit("false"))
        else:
            c = c.cast(StringType())
        out.append(c.alias(f.name))
    return df.select(out)


def report_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; NULL written as an empty field."""
    as_text(df).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def report_json(df: DataFrame, path: str, name: str) -> None:
    """``{path}/rows``: one JSON object per row, keys in column order, nulls
    kept; ``{path}/header``: one record with the report name and the keys."""
    keyed = report_keys(df)
    ts_cols = [
        f.name for f in keyed.schema.fields if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))
    ]
    for c in ts_cols:
        keyed = keyed.withColumn(c, F.date_format(c, "yyyy-MM-dd"))
    keyed.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/rows")
    spark = df.sparkSession
    header = spark.createDataFrame([(name, keyed.columns)], "report string, columns array<string>")
    header.coalesce(1).write.mode("overwrite").json(f"{path}/header")  # one record


def report_head(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows in report order (the sort is kept: the plan is a
    per-partition top-n and one merge); ``None`` keeps all rows."""
    return df if n is None else df.limit(n)


def daily_sales_payload(
    summary: DataFrame, day: dt.date, generated_at: dt.datetime | None = None
) -> DataFrame:
    """The summary row as the JSON document a BI consumer expects: money as
    exact two-decimal numbers, a NULL top category kept, UTC second stamp."""
    if generated_at is None:
        generated_at = dt.datetime.now(dt.timezone.utc)
    if generated_at.tzinfo is not None:
        generated_at = generated_at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    stamp = generated_at.replace(microsecond=0).strftime("%Y-%m-%dT%H:%M:%SZ")
    doc = F.struct(
        F.lit(DAILY_SALES_REPORT_TYPE).alias("report_type"),
        F.lit(day.isoformat()).alias("date"),
        F.struct(
            F.col("total_revenue").cast(DecimalType(38, 2)).alias("total_revenue"),
            F.col("total_orders").alias("total_orders"),
            F.col("average_order_value").cast(DecimalType(38, 2)).alias("average_order_value"),
            F.col("top_category").alias("top_category"),
        ).alias("data"),
        F.lit(stamp).alias("generated_at"),
    )
    return summary.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("payload"))


def snapshot_path(root: str, report: str, args: dict, day: dt.date, version: str = SNAPSHOT_VERSION) -> str:
    """Folder of one snapshot: keyed by version, report, arguments and local day."""
    key = json.dumps({"v": version, "report": report, "args": args, "day": day.isoformat()}, sort_keys=True)
    digest = hashlib.sha256(key.encode()).hexdigest()[:24]
    return f"{root.rstrip('/')}/report={report}/day={day.isoformat()}/key={digest}"


def report_snapshot(
    spark: SparkSession,
    root: str,
    report: str,
    args: dict,
    compute: Callable[[], DataFrame],
    *,
    now: dt.datetime | None = None,
    ttl: dt.timedelta = DEFAULT_TTL,
    refresh: bool = False,
    tz: str = tu.REPORT_TZ,
) -> DataFrame:
    """Serve a report from its snapshot while fresh; otherwise compute it,
    write it to a folder of its own, then publish a manifest that names the
    folder, and serve the written copy.

    Manifests are numbered and never changed: one is put under the next free
    number, which fails if another refresh was faster (then the number after is
    tried), and readers take the highest one that is complete.  So a reader
    always finds a snapshot, whatever refreshes do meanwhile.  Frames handed out
    before keep reading their own folder; a folder is removed by a refresh that
    comes ``ttl`` or more after another manifest took its place.

    The key holds the local day of ``now``, so a new day never reads
    yesterday's snapshot.  A failed computation raises before anything is
    written, so errors are never stored.
    """
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    day = tu.yesterday_in(now, tz) + dt.timedelta(days=1)
    path = snapshot_path(root, report, args, day)
    found = _manifests(spark, path)
    if found and not refresh and dt.datetime.fromisoformat(found[-1][1]["expires_at"]) > now:
        return spark.read.parquet(found[-1][1]["rows"])
    rows = f"{path}/rows-{uuid.uuid4().hex}"
    compute().write.parquet(rows)
    _publish(spark, path, {"rows": rows, "published_at": now.isoformat(), "expires_at": (now + ttl).isoformat()})
    _drop_replaced(spark, path, now)
    return spark.read.parquet(rows)


def _folder(spark: SparkSession, name: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """(number, record) of the complete manifests, the newest last."""
    fs, folder = _folder(spark, f"{path}/_manifests")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.endswith(".json"):
            continue
        try:
            stream = fs.open(status.getPath())
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append((int(name.removesuffix(".json")), json.loads(text)))
        except (ValueError, Py4JJavaError):  # still being written, or removed meanwhile
            continue
    return sorted(out, key=lambda m: m[0])


def _publish(spark: SparkSession, path: str, record: dict) -> int:
    """Put the record under the next free number; the number."""
    fs, folder = _folder(spark, f"{path}/_manifests")
    fs.mkdirs(folder)
    taken = [s.getPath().getName().removesuffix(".json") for s in fs.listStatus(folder)]
    number = 1 + max((int(n) for n in taken if n.isdigit()), default=0)
    while True:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests/{number:012d}.json")
        try:
            stream = fs.create(target, False)  # fails if it exists
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            number += 1  # another refresh was faster
            continue
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        return number


def _drop_replaced(spark: SparkSession, path: str, now: dt.datetime) -> None:
    """Remove rows and manifests whose successor has been there for its ttl."""
    found = _manifests(spark, path)
    for (number, old), (_, after) in zip(found[:-1], found[1:]):
        if dt.datetime.fromisoformat(after["expires_at"]) <= now:
            _remove(spark, old["rows"])
            _remove(spark, f"{path}/_manifests/{number:012d}.json")


def _remove(spark: SparkSession, folder: str) -> None:
    fs, where = _folder(spark, folder)
    fs.delete(where, True)


def snapshot_many(
    spark: SparkSession,
    root: str,
    jobs: list[tuple[str, dict, Callable[[], DataFrame]]],
    **kwargs,
) -> list[tuple[str, DataFrame | None, Exception | None]]:
    """Several reports in one run, in input order; a failing report is
    reported with its error and does not stop the others."""
    results = []
    for report, args, compute in jobs:
        try:
            results.append((report, report_snapshot(spark, root, report, args, compute, **kwargs), None))
        except Exception as exc:  # isolate one report's failure
            results.append((report, None, exc))
    return results


def run_summary(spark: SparkSession, results) -> DataFrame:
    """(report, row_count, error) of a run, one row per report."""
    schema = "report string, row_count long, error string"
    out = spark.createDataFrame([], schema)
    for report, df, error in results:
        if df is None:
            row = spark.createDataFrame([(report, None, str(error)[:500])], schema)
        else:
            row = df.agg(F.count("*").alias("row_count")).select(
                F.lit(report).alias("report"), "row_count", F.lit(None).cast("string").alias("error")
            )
        out = out.unionByName(row)
    return out
