"""Old layout -> shop model: canonical status, category text -> key,
zoneless local time -> UTC instant; rows that cannot be mapped are kept with
a reject reason instead of being dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType

from kassa.functions import timeutil as tu

# Accepted spellings (after trim + lower) of each status.
STATUS_ALIASES = {
    "completed": "completed",
    "complete": "completed",
    "pending": "pending",
    "cancelled": "cancelled",
    "canceled": "cancelled",
}


def normalise_legacy_orders(legacy: DataFrame, tz: str = tu.REPORT_TZ) -> DataFrame:
    """Columns of the model's orders plus ``reject_reason`` (NULL = accepted)."""
    aliases = F.create_map(*[F.lit(x) for kv in STATUS_ALIASES.items() for x in kv])
    status = aliases[F.lower(F.trim(F.col("status")))]
    reason = (
        F.when(F.col("customer_id").isNull(), F.lit("customer_id missing"))
        .when(F.col("order_date").isNull(), F.lit("order_date missing"))
        .when(status.isNull(), F.lit("unknown status"))
        .when(F.col("total_amount").isNull() | (F.col("total_amount") < 0), F.lit("bad total_amount"))
    )
    return legacy.select(
        F.col("id").cast(LongType()).alias("id"),
        F.col("customer_id").cast(LongType()).alias("customer_id"),
        F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col("order_date")).alias("order_date"),
        status.alias("status"),
        F.col("total_amount").cast(DecimalType(12, 2)).alias("total_amount"),
        reason.alias("reject_reason"),
    )


def normalise_legacy_products(legacy: DataFrame, categories: DataFrame) -> DataFrame:
    """Category text resolved to the category key by trimmed, case-blind
    name; a name that does not resolve, or that several categories share when
    case is ignored, is a reject; a missing one is NULL.  Every row comes out
    once.  The categories side is the catalogue dimension (broadcast by size)."""
    names = categories.groupBy(F.lower(F.trim("name")).alias("_cat_key")).agg(
        F.count("*").alias("_n"), F.min("id").alias("_id")
    )
    names = names.select("_cat_key", F.when(F.col("_n") == 1, F.col("_id")).alias("category_id"), "_n")
    j = legacy.join(names, F.lower(F.trim(F.col("category"))) == F.col("_cat_key"), "left")
    reason = F.when(F.col("_n") > 1, F.lit("ambiguous category")).when(
        F.col("category").isNotNull() & F.col("category_id").isNull(), F.lit("unknown category")
    )
    return j.select(
        F.col("id").cast(LongType()).alias("id"),
        "name",
        F.col("category_id").cast(LongType()).alias("category_id"),
        F.col("price").cast(DecimalType(10, 2)).alias("price"),
        F.coalesce(F.col("stock_quantity"), F.lit(0)).cast(IntegerType()).alias("stock_quantity"),
        reason.alias("reject_reason"),
    )


def set_aside(normalised: DataFrame, path: str) -> None:
    """Write the result in one pass: accepted rows under ``accepted=true``,
    rejects with their reason under ``accepted=false``."""
    rows = normalised.withColumn("accepted", F.col("reject_reason").isNull())
    rows.write.mode("overwrite").partitionBy("accepted").parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("accepted = 'false'").drop("accepted")


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("accepted = 'true'").drop("accepted", "reject_reason")
