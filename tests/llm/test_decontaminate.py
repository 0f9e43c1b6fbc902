import hashlib
import random
import re

import pytest
from llm_cases import ROWS, frame

from kassa.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(folded)


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        own = words(body)
        size = min(len(own), 10)
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(doc) - size + 1):
                if doc[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(doc), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def check(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(frame(spark, rows), bench).collect()
    assert len(got) == len(rows)
    texts = {}
    for d, t in rows:
        texts[d] = t
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == brute(texts[r.doc_id], items), r.doc_id
        assert r.contaminated == (r.n_hit > 0)


def test_random_items(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(100, 140)]
    items += [(1, None), (2, ""), (100, "Z z, Z! z"), (7, "Één Öl")]
    rows = [(d, " ".join(rng.choice(["a", "b", "C", "d,", "x"]) for _ in range(rng.randrange(80)))) for d in range(60)]
    check(spark, rows + [(99, "z z z z z"), (98, "Één öl, Één Öl")], items)


def test_long_items(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice(["p", "q"]) for _ in range(30))) for i in range(20)]
    rows = [(d, " ".join(rng.choice(["p", "Q"]) for _ in range(60))) for d in range(30)]
    check(spark, rows, items)


def test_edge_rows(spark):
    check(spark, ROWS, [(1, "Straße und Öl. Straße und Öl. Straße und Öl. Straße und Öl."), (2, "one two"), (3, "don't")])
    check(spark, ROWS, [])
    assert D.find_contamination(frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_spans_go_and_the_rest_stays(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rest = " ".join(f"r{i}" for i in range(30))
    rows = [(1, f"{rest}. {passage}! {rest}"), (2, rest), (3, passage + " x"), (4, None), (5, "")]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(9, passage)], "item_id long, text string")
    out = D.remove_contamination(docs, bench)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    clean = f"{rest}. ! {rest}"
    assert got == {1: (clean, len(clean)), 2: (rest, len(rest)), 4: (None, 0), 5: ("", 0)}


def test_items_beyond_the_bound_are_refused(spark):
    bench = spark.createDataFrame([(1, "x" * 50)], "item_id long, text string")
    with pytest.raises(ValueError, match="at most"):
        D.find_contamination(frame(spark), bench, max_item_bytes=10)
