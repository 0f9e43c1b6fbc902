"""Tables written once, bucketed by a column, so that joins, aggregates and
windows on that column read them without a shuffle.

Spark keeps the bucketing of a table in its catalogue only, so the files are
written as an external table and the entry is dropped again at once: the frame
that was resolved before keeps files and buckets, and nothing is left behind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kassa.session import ensure_checkpoint_dir


def least_buckets(spark: SparkSession) -> int:
    """With fewer buckets than its shuffles have partitions, Spark prefers to
    shuffle the bucketed side of a join again."""
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or shuffle)


def write_bucketed(df: DataFrame, column: str, buckets: int, name: str, path: str | None = None) -> DataFrame:
    """``df`` written under ``path`` (a fresh folder under spark.checkpoint.dir
    if not given) in ``buckets`` buckets of ``column``, read back."""
    spark = df.sparkSession
    table = f"kassa_{name}_{uuid.uuid4().hex}"
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-tables/{table}"
    if buckets > int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")):
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", str(buckets))
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {table}")
    return out
