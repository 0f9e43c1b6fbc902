"""Intermediate tables in the shared folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kassa.session import ensure_checkpoint_dir


def session(spark: SparkSession) -> SparkSession:
    """Adaptive planning on, and Arrow batches bounded in rows: a task slices
    what it gets into blocks of a few megabytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def save(df: DataFrame, name: str) -> DataFrame:
    """Write a table under spark.checkpoint.dir and read it back: cuts the
    lineage, survives lost executors, and keeps column pruning."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
