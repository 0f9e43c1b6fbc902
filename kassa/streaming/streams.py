"""Structured Streaming jobs.

``stream_daily_sales``: purchase events read as a file stream, completed
orders and revenue per Jakarta day in event-time windows.  A day is one
tumbling window starting at 17:00 UTC (Jakarta midnight).  Each batch adds its
sums for the days still open, so today's day is there too; rows more than
``lateness`` late for a closed day are set aside and counted exactly.
``daily_sales_stream`` is the same as one stateful aggregate, for sinks that take
updates.

``stream_customer_monthly_summary``: order changes read as a file stream;
each micro-batch names the touched customers and ``foreachBatch`` rewrites
their (customer, month) rows of the summary table from the orders table.
The table is partitioned by customer bucket and only the touched buckets are
read and replaced (dynamic partition overwrite), so a batch costs its
buckets, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.utils import AnalysisException

from kassa.functions import timeutil as tu
from kassa.operators.sequence import materialize
from kassa.operators.shared import customer_monthly_summary
from kassa.sources.driver_tables import DRIVER_SCHEMAS
from kassa.sources.model import Shop

# Jakarta's offset (+07:00, no daylight saving), so a Jakarta
# day is the window starting at 17:00 UTC.
JAKARTA_OFFSET_HOURS = 7
DAY_START_UTC = f"{24 - JAKARTA_OFFSET_HOURS} hours"
DEFAULT_LATENESS = "6 hours"


def _file_stream(spark: SparkSession, folder: str, schema, name_glob: str | None, max_files: int | None):
    """A parquet file stream over ``folder`` (new files are new data);
    ``name_glob`` restricts it to matching file names."""
    reader = spark.readStream.schema(schema)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def purchase_stream(
    spark: SparkSession, folder: str, name_glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    e = _file_stream(spark, folder, DRIVER_SCHEMAS["events"], name_glob, max_files_per_trigger)
    e = e.filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        tu.instant("ts").alias("order_time"),
        F.col("value").cast(DecimalType(12, 2)).alias("total_amount"),
    )


def daily_sales_stream(orders: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Windowed daily aggregate of a stream of completed orders with an
    ``order_time`` (timestamp) column."""
    w = F.window("order_time", "1 day", "1 day", DAY_START_UTC)
    return (
        orders.withWatermark("order_time", lateness)
        .groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("total_amount").alias("revenue"))
        .select(
            tu.day_of_instant(F.col("w.start"), JAKARTA_OFFSET_HOURS).alias("day"),
            "total_orders",
            "revenue",
        )
    )


_DAY_TABLE = "total_orders long, revenue decimal(22,2), day date, batch long"
_SEEN_TABLE = "newest timestamp, late long"


def read_daily_sales(spark: SparkSession, sink_path: str) -> DataFrame:
    """day, total_orders, revenue: every day with an order so far."""
    parts = spark.read.schema(_DAY_TABLE).parquet(sink_path)
    return parts.groupBy("day").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("revenue").cast(DecimalType(22, 2)).alias("revenue")
    )


def read_late_rows(spark: SparkSession, sink_path: str) -> DataFrame:
    """The rows set aside because their day was closed, with their batch."""
    schema = "id long, customer_id long, order_time timestamp, total_amount decimal(12,2), batch long"
    try:
        return spark.read.schema(schema).parquet(f"{sink_path}/_late")
    except AnalysisException:  # none so far
        return spark.createDataFrame([], schema)


def run_daily_sales(
    spark: SparkSession,
    events_folder: str,
    sink_path: str,
    checkpoint_path: str,
    lateness: str = DEFAULT_LATENESS,
    name_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Process everything available now and stop.  Returns the exact number of
    input rows that came too late in this run; the rows themselves are set aside
    (:func:`read_late_rows`).

    A day is closed once it ends at or before the watermark: the newest order
    time of all batches before, less ``lateness``.  Each batch writes its own
    sum for each open day, in a folder of that day and batch, its late rows, and
    one record with the newest time and the late rows so far, which the next batch
    starts from.  No state is held between batches, and all three are replaced if a
    batch is run again, so a restart neither loses nor counts anything twice."""
    run = {"first": None, "last": None}  # batch numbers of this run

    def seen(batch_id: int):
        return spark.read.schema(_SEEN_TABLE).parquet(f"{sink_path}/_seen/batch={batch_id}").first()  # one record

    def add(batch: DataFrame, batch_id: int) -> None:
        if run["first"] is None:
            run["first"] = batch_id
        run["last"] = batch_id
        before = seen(batch_id - 1) if batch_id > 0 else None
        mark = F.lit(before["newest"] if before else None).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        end = F.window("order_time", "1 day", "1 day", DAY_START_UTC)
        batch = batch.withColumn("_start", end["start"]).withColumn("_end", end["end"])
        batch = batch.withColumn("_late", F.coalesce(F.col("_end") <= mark, F.lit(False))).persist()
        try:
            counts = batch.agg(F.max("order_time").alias("newest"), F.count_if("_late").alias("late")).first()
            if counts["late"]:
                late = batch.where("_late").select("id", "customer_id", "order_time", "total_amount")
                late.write.mode("overwrite").parquet(f"{sink_path}/_late/batch={batch_id}")
            days = (
                batch.where("NOT _late")
                .groupBy(tu.day_of_instant(F.col("_start"), JAKARTA_OFFSET_HOURS).alias("day"))
                .agg(
                    F.count(F.lit(1)).alias("total_orders"),
                    F.sum("total_amount").cast(DecimalType(22, 2)).alias("revenue"),
                )
            )
            (
                days.withColumn("batch", F.lit(batch_id).cast("long"))
                .select("total_orders", "revenue", "day", "batch")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day", "batch")
                .parquet(sink_path)
            )
            newest = [t for t in (counts["newest"], before and before["newest"]) if t is not None]
            record = [(max(newest, default=None), counts["late"] + (before["late"] if before else 0))]
            spark.createDataFrame(record, _SEEN_TABLE).coalesce(1).write.mode("overwrite").parquet(
                f"{sink_path}/_seen/batch={batch_id}"
            )
        finally:
            batch.unpersist()

    q = (
        purchase_stream(spark, events_folder, name_glob, max_files_per_trigger)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if run["last"] is None:
        return 0
    earlier = seen(run["first"] - 1)["late"] if run["first"] > 0 else 0
    return seen(run["last"])["late"] - earlier


ROWS_PER_BUCKET = 500_000


def customer_bucket(buckets: int, col: str = "customer_id"):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def write_summary_table(summary: DataFrame, table_path: str, buckets: int | None = None) -> None:
    """The summary table, one folder per customer bucket.  The number of
    buckets follows the rows (``ROWS_PER_BUCKET``) unless given; it is kept
    with the table, as later batches must use the same."""
    if buckets is None:
        summary = materialize(summary, "summary")
        buckets = 1 + summary.count() // ROWS_PER_BUCKET
    (
        summary.withColumn("bucket", customer_bucket(buckets))
        .hint("rebalance", "bucket")  # few files a bucket; adaptive execution splits a large one
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(table_path)
    )
    record = summary.sparkSession.createDataFrame([(buckets,)], "buckets int").coalesce(1)
    record.write.mode("overwrite").json(f"{table_path}/_buckets")


def read_summary_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The summary rows (bucket markers, whose customer_id is NULL, dropped)."""
    return spark.read.parquet(table_path).filter(F.col("customer_id").isNotNull()).drop("bucket")


def upsert_touched(
    spark: SparkSession, shop: Shop, touched: DataFrame, table_path: str
) -> None:
    """Rewrite the summary rows of ``touched`` customers.

    Only the touched customers' buckets are read (partition pruning) and
    overwritten (dynamic partition overwrite); their other customers' rows
    are carried over.  The new bucket contents are checkpointed first, so the
    write does not read the folders it replaces.
    """
    buckets = spark.read.schema("buckets int").json(f"{table_path}/_buckets").first()["buckets"]
    touched = materialize(
        touched.select("customer_id").distinct().withColumn("bucket", customer_bucket(buckets)), "touched"
    )
    hit = materialize(touched.select("bucket").distinct(), "buckets").where("bucket >= 0")
    # the touched buckets prune the scan at run time (dynamic partition pruning), whatever their number
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    existing = spark.read.parquet(table_path).where("customer_id IS NOT NULL").join(hit, "bucket", "left_semi")
    keep = existing.join(touched.select("customer_id"), "customer_id", "left_anti")
    fresh = customer_monthly_summary(_restricted(shop, touched.select("customer_id"))).withColumn(
        "bucket", customer_bucket(buckets)
    )
    # one marker row per touched bucket, so a bucket left without rows is
    # still replaced (dynamic overwrite only replaces folders it writes)
    markers = hit.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in keep.schema.fields if f.name != "bucket"], "bucket"
    )
    new_rows = materialize(
        keep.unionByName(fresh.select(keep.columns)).unionByName(markers.select(keep.columns)), "summary"
    )
    (
        new_rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(table_path)
    )


def run_customer_monthly_summary(
    spark: SparkSession,
    shop: Shop,
    changes_folder: str,
    table_path: str,
    checkpoint_path: str,
    changes_schema=None,
    name_glob: str | None = None,
) -> str:
    """Upsert touched customers' months for every batch of order changes.

    ``changes_folder`` receives order change records (``customer_id`` or the
    driver's ``o_custkey``, and ``old_customer_id`` where an order moved to
    another customer, whose rows are then refreshed too); ``table_path`` holds the bucketed summary table
    (built with :func:`write_summary_table`).  A batch that fails leaves the
    untouched buckets as they were and is replayed from the checkpoint; the
    rewrite of a bucket is idempotent.
    """
    schema = changes_schema or DRIVER_SCHEMAS["orders"]
    changes = _file_stream(spark, changes_folder, schema, name_glob, None)
    key = "o_custkey" if "o_custkey" in schema.fieldNames() else "customer_id"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(F.col(key).alias("customer_id"))
        if "old_customer_id" in batch.columns:
            touched = touched.union(batch.select("old_customer_id").where("old_customer_id IS NOT NULL"))
        upsert_touched(spark, shop, touched, table_path)

    q = (
        changes.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return table_path


def _restricted(shop: Shop, customers: DataFrame) -> Shop:
    class _Sub(Shop):
        def orders_in_status(self, *statuses):
            return shop.orders_in_status(*statuses).join(customers, "customer_id", "left_semi")

    return _Sub(shop.customers, shop.categories, shop.products, shop.orders, shop.order_items)
