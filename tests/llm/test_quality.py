import duckdb
import numpy as np
from llm_cases import ROWS, frame

from kassa.llm import quality_rules as Q
from kassa.llm.quality_classifier import classify
from kassa.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"
PROSE = "\n".join(" ".join(f"{w}{i}" for w in ("This", "is", "clean", "prose", "with", "words", "of", "its", "own")) + "." for i in range(12))


def test_line_rules(spark):
    junk = "Home | News | About | Contact\nAccept our Cookie Policy to go on.\nclick\n# * $ %\n" + PROSE.split("\n")[3]
    rows = [
        (1, PROSE),
        (2, junk + "\n" + PROSE),
        (3, "\n".join(f"Menu{i} | item{i} | go" for i in range(40))),
        (4, "word " * 200),
        (5, "Too short."),
    ]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in Q.judge_lines(docs).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert got[1].clean_text == PROSE and got[1].n_lost_words == 0
    # the repeated line came first, so the later one goes
    first = PROSE.split("\n")[3]
    assert got[2].clean_text == first + "\n" + PROSE.replace(first + "\n", "")
    assert got[2].n_dup_lines == 1 and not got[2].base_failed
    assert (got[3].base_failed, got[4].base_failed, got[5].base_failed) == (False, True, True)
    assert sorted(r.doc_id for r in Q.clean_documents(docs).collect()) == [1, 2]


def test_each_line_rule_alone():
    """Every rule has a line that only it fails; near misses of each stay."""
    fails = {
        "boilerplate": "Please read our privacy policy before you go on with it.",
        "navigation, separators": "Start / Waren / Firma / Kontakt",
        "navigation, dots": "Start · Waren · Firma · Kontakt heute",
        "navigation, menu words": "Home About Contact Login Register",
        "symbols": "one two three # four five six seven eight nine",
        "symbols in a sentence": "$$$ %%% wow.",
        "punctuation": "Read on",
    }
    for rule, line in fails.items():
        assert Q.line_fails(line.encode(), len(line.split())), rule
    stay = [
        "Sales rose by 5% in March, she said.",
        "AT&T said it would pay the fine.",
        "We went home / back to the contact that we had about it all",
        "They share more news about home.",
        "Read on!",
        "He said \"stop.\"",
        "The privacy of its terms is a policy matter",
    ]
    for line in stay:
        assert not Q.line_fails(line.encode(), len(line.split())), line


def test_edge_rows(spark):
    docs = frame(spark)
    got = Q.judge_lines(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r.n_words == len((r.text or "").encode().split())
        assert r.chunk == "x" and r.score == "x"
        if not r.n_words:
            assert (r.base_failed, r.kept, r.clean_text) == (True, False, "")
    assert Q.judge_lines(frame(spark, [])).collect() == []
    assert Q.clean_documents(docs).columns == docs.columns


def test_good_documents_stay(spark):
    con = duckdb.connect()
    good = {r[0] for r in con.sql(f"SELECT doc_id FROM '{SF01}/labels.parquet' WHERE quality = 1").fetchall()}
    rules = [r for r in QUERIES["op4_quality_rules"](spark, SF01).collect() if r.doc_id in good and not r.base_failed]
    assert all(r.kept for r in rules)


def test_classifier(spark):
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    got = QUERIES["op1_quality_classifier"](spark, SF01).collect()
    assert len(got) == 1000
    right = [r.kept == bool(label[r.doc_id]) for r in got if r.doc_id in label]
    assert np.mean(right) > 0.97
    assert all(0 <= p <= 1 for r in got for p in (r.p_doc, r.p_host, r.p_path, r.score))


def test_sparse_sites_shrink(spark):
    """A host of bad texts pulls its paths down; a single bad text does not."""
    bad = "#$% | ** " * 60
    rows = [(i, PROSE, "en", "good") for i in range(60)] + [(100 + i, bad, "en", "bad") for i in range(60)]
    rows += [(200, bad, "en", "rare"), (201, PROSE, "de", "bad"), (202, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert len(got) == len(rows)
    assert got[101].p_host < 0.2 < 0.8 < got[1].p_host
    assert got[101].p_host < got[200].p_host < got[1].p_host
    assert got[101].p_path < got[201].p_path < got[1].p_path
    assert got[1].kept and not got[101].kept and got[201].kept


def test_classifier_edge_rows(spark):
    labels = spark.createDataFrame([(6, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    assert len(classify(frame(spark), labels).collect()) == len(ROWS)
    none = classify(frame(spark), labels.limit(0)).collect()
    assert {r.p_doc for r in none} == {0.5}
    assert classify(frame(spark, []), labels).collect() == []
