"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm.store import save


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)``, the component being its
    smallest node.  Nodes without an edge are absent.

    Each step groups the edges by node with ``min`` (partial aggregates, so a
    node with very many edges costs no large task) and joins the minimum back;
    a step that changes nothing ends the loop.  State is written between steps.
    """
    now = save(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        after = save(
            small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "edges",
        )
        if _same(now, after):
            break
        now = after
    root = after.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return save(
        root.union(root.select(F.col("component").alias("node"), "component")).distinct(), "components"
    )


def _same(a: DataFrame, b: DataFrame) -> bool:
    def digest(df):
        h = F.xxhash64("u", "v")
        return df.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first()

    return digest(a) == digest(b)
