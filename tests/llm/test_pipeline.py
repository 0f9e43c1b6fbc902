"""Each stage against its plain version on what the stage before kept."""

import corpus_pipeline
import duckdb
from pyspark.sql import functions as F
from test_decontaminate import brute as hits
from test_minhash import brute as groups
from test_suffix import brute as repeats

SF001 = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    step = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        step[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    rules, near = step["quality_rules"], step["near_duplicates"]
    linked = groups(list(rules.items()), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert rules and set(near) == {d for d, (_, c) in linked.items() if c == d}
    assert all(near[d] == rules[d] for d in near)
    want = repeats(list(near.items()))
    kept = step["repeated_passages"]
    assert set(kept) == set(near)
    for d, text in kept.items():
        assert (text == near[d]) == (want[d][1] == 0)
        assert len(text.encode()) <= want[d][0] - want[d][1]
    clean = step["benchmark_passages"]
    for d, text in kept.items():
        n, hit, _, _ = hits(text, items)
        assert (d in clean) == (2 * hit <= n)
        if d in clean:
            assert (clean[d] == text) == (hit == 0)
            assert hits(clean[d], items)[1] == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {p.doc_id for p in pieces} == set(clean)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
