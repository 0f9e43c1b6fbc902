"""Registered queries of the operators, in contract form, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.llm.store import session

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


PAGES = "page_id long, url string, html string"
EMBEDDINGS = "vec_id long, embedding array<float>"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session(spark).read.schema(PAGES).parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = session(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return columns.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), F.col("toxic").cast("int"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.quality_classifier import classify

    return classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.decontaminate import find_contamination

    docs = documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.toxicity import THRESHOLD, fit, score

    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = fit(docs, labels(spark, sf_dir).where(~held_out).select("doc_id", "toxic"))
    held_out = F.coalesce(held_out, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return score(docs, model).select("doc_id", held_out, "score", predicted)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.quality_rules import judge_lines

    return judge_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lost_words",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.suffix_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), with_text=False)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.license_scan import scan_licenses

    return scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.minhash_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.html_extract import extract, fit

    rows = pages(spark, sf_dir)
    return extract(rows, fit(rows))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.packing import pack_sequences

    return pack_sequences(documents(spark, sf_dir))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.url_filter import filter_urls

    return filter_urls(pages(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.whitening import whiten

    rows = session(spark).read.schema(EMBEDDINGS).parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(rows)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.substring_dedup import remove_repeated_windows

    return remove_repeated_windows(documents(spark, sf_dir).select("doc_id", "text"), with_text=False)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kassa.llm.filter_audit import audit_filters

    return audit_filters(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_filter_audit": op13_filter_audit,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from kassa.llm.sql import SQL

    return {k: v for k, v in SQL.items() if k in QUERIES}
