"""The corpus pipeline: line rules, near-duplicates, repeated passages,
benchmark passages, packing.  Each stage works on all that the one before kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.llm.decontaminate import remove_contamination
from kassa.llm.minhash_dedup import keep_one
from kassa.llm.packing import pack_sequences
from kassa.llm.quality_rules import clean_documents
from kassa.llm.queries import DOCUMENTS, documents
from kassa.llm.store import session
from kassa.llm.suffix_dedup import remove_repeats
from kassa.session import ensure_checkpoint_dir


#: Of the near_duplicates stage: words a shingle, and similarity in hundredths.
#: tests/llm/test_pipeline.py holds the stage to these.
SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    session(spark)
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates."""
    session(spark)
    return keep_one(docs, SHINGLE, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller doc_id has."""
    session(spark)
    done = remove_repeats(docs).withColumn("text", F.col("clean_text"))
    done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark items."""
    items = session(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return remove_contamination(docs, items)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    session(spark)
    return pack_sequences(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]

#: SQL cannot express tokenisation and packing; tests/llm tests each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as
    Parquet in the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-llm/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(DOCUMENTS).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
