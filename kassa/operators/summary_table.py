"""The (customer, month) summary as a stored table kept up to date by deltas.

The table has one folder per month and customer bucket.  Change records carry an
order's row before and after the change (either may be absent: a new or a deleted
order); each gives the month it left -1 order and minus its amount, and the month
it came to +1 and its amount.  Only these sums meet the table, and only the
folders that they name are read and replaced: what a refresh costs follows the
changes and their folders, not the table or the orders, and a moved, deleted or
re-dated order needs no look at the orders table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from kassa.functions import timeutil as tu
from kassa.operators.sequence import materialize
from kassa.sources.model import STATUS_COMPLETED

#: Columns of an image; a change record has them with ``old_`` and ``new_``.
IMAGE = ["customer_id", "order_date", "status", "total_amount"]
ROWS_PER_FOLDER = 500_000
_TABLE = "customer_id long, order_month date, order_count long, revenue decimal(38,2), month string, bucket int"


def _placed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("month", F.date_format("order_month", "yyyy-MM")).withColumn(
        "bucket", F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int")
    )


def _shaped(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id",
        "order_month",
        F.col("order_count").cast(LongType()).alias("order_count"),
        F.col("revenue").cast(DecimalType(38, 2)).alias("revenue"),
        "month",
        "bucket",
    )


def write_monthly_table(summary: DataFrame, path: str, buckets: int | None = None) -> None:
    """Write ``summary`` (customer_id, order_month, order_count, revenue).  The
    buckets of a month follow the rows of the largest one unless given; they are
    kept with the table."""
    if buckets is None:
        summary = materialize(summary, "summary")
        most = summary.groupBy("order_month").count().agg(F.max("count")).first()[0] or 0
        buckets = 1 + most // ROWS_PER_FOLDER
    rows = _shaped(_placed(summary, buckets)).hint("rebalance", "month", "bucket")
    rows.write.mode("overwrite").partitionBy("month", "bucket").parquet(path)
    record = summary.sparkSession.createDataFrame([(buckets,)], "buckets int").coalesce(1)
    record.write.mode("overwrite").json(f"{path}/_buckets")


def read_monthly_table(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(_TABLE).parquet(path).where("customer_id IS NOT NULL")
    return rows.select("customer_id", "order_month", "order_count", "revenue")


def signed_deltas(changes: DataFrame, tz: str = tu.REPORT_TZ) -> DataFrame:
    """(customer_id, order_month, order_count, revenue) to add to the summary.
    Several changes of one order in a row add up to the first and last image."""

    def image(side: str, sign: int):
        return F.struct(
            F.col(f"{side}_customer_id").alias("customer_id"),
            F.col(f"{side}_order_date").alias("order_date"),
            F.col(f"{side}_status").alias("status"),
            F.lit(sign).cast(LongType()).alias("order_count"),
            (F.col(f"{side}_total_amount") * sign).cast(DecimalType(38, 2)).alias("revenue"),
        )

    both = changes.select(F.inline(F.array(image("old", -1), image("new", 1))))
    counted = both.where((F.col("status") == STATUS_COMPLETED) & F.col("customer_id").isNotNull())
    sums = counted.groupBy("customer_id", tu.local_month("order_date", tz).alias("order_month")).agg(
        F.sum("order_count").alias("order_count"), F.sum("revenue").alias("revenue")
    )
    return sums.where("order_count <> 0 OR revenue <> 0")


def merged_folders(spark: SparkSession, path: str, deltas: DataFrame) -> DataFrame:
    """New contents of the folders that ``deltas`` name, and one marker row (null
    customer) for each, so that a folder left without rows is replaced too."""
    buckets = spark.read.schema("buckets int").json(f"{path}/_buckets").first()["buckets"]
    deltas = materialize(_shaped(_placed(deltas, buckets)), "deltas")
    folders = materialize(deltas.select("month", "bucket").distinct(), "folders").where("bucket >= 0")
    # the folders prune the scan at run time (dynamic partition pruning), whatever their number
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    held = spark.read.schema(_TABLE).parquet(path).where("customer_id IS NOT NULL")
    held = held.join(folders, ["month", "bucket"], "left_semi")
    count = F.sum("order_count")
    rows = (
        held.select(*deltas.columns)
        .unionByName(deltas)
        .groupBy("customer_id", "order_month", "month", "bucket")
        .agg(
            F.when(count < 0, F.raise_error(F.lit("a change names an order that the summary does not hold")))
            .otherwise(count)
            .cast(LongType())
            .alias("order_count"),
            F.sum("revenue").alias("revenue"),
        )
        .where("order_count > 0")
    )
    nothing = [F.lit(None).cast(t).alias(c) for c, t in deltas.dtypes if c not in ("month", "bucket")]
    return _shaped(rows).unionByName(_shaped(folders.select(*nothing, "month", "bucket")))


def apply_changes(
    spark: SparkSession, path: str, changes: DataFrame, batch: int, tz: str = tu.REPORT_TZ
) -> None:
    """Merge one batch of change records into the table.

    The new contents are staged under the batch's number first; a batch that was
    broken off is finished from there, and one that is done is not applied again,
    so running a batch twice does no harm.  Batches are applied one at a time."""
    done, stage = f"{path}/_done/batch={batch}", f"{path}/_stage/batch={batch}"
    if _exists(spark, f"{done}/_SUCCESS"):
        return
    if not _exists(spark, f"{stage}/_SUCCESS"):
        merged_folders(spark, path, signed_deltas(changes, tz)).write.mode("overwrite").parquet(stage)
    (
        spark.read.schema(_TABLE)
        .parquet(stage)
        .hint("rebalance", "month", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "bucket")
        .parquet(path)
    )
    spark.range(1).coalesce(1).write.mode("overwrite").json(done)
    _path(spark, stage)[0].delete(_path(spark, stage)[1], True)


def _path(spark: SparkSession, name: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, name: str) -> bool:
    fs, where = _path(spark, name)
    return fs.exists(where)
