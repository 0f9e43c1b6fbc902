"""The filter audit against a plain run of every order."""

import random
import re
from itertools import permutations

from llm_cases import ROWS, frame

from kassa.llm import filter_audit as A


def plain(rows, labels):
    """rows: (doc_id, text, source); labels: doc_id -> (quality, toxic)."""
    fails = []
    for doc, text, _ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        twin = doc is not None and any(
            d is not None and d < doc and (u or "") == t for d, u, _ in rows
        )
        fails.append(
            {
                "A": len(w) < 50,
                "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": re.search(r"[#$%&*|]", t) is not None,
                "E": twin,
            }
        )
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(f, labels.get(r[0], (0, 0))) for f, r in zip(fails, rows, strict=True) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if x[0][name]]
                left = [x for x in left if not x[0][name]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(x[0][name] for x in mine) - len(gone),
                    sum(x[0][name] and sum(x[0].values()) == 1 for x in mine),
                    sum(x[1][0] == 1 for x in gone),
                    sum(x[1][1] == 1 for x in gone),
                ]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[name])
    return out


def found(docs, labels, **options):
    rows = A.audit_filters(docs, labels, **options).collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in A.COUNTS] for r in rows}
    assert len(out) == len(rows)
    return out


def corpus():
    draw = random.Random(5)
    texts = []
    for _ in range(60):
        w = [draw.choice(["one", "Two", "THREE", "x#", f"w{draw.randrange(500)}"]) for _ in range(draw.choice((3, 70, 90)))]
        texts.append(" ".join(w))
    texts += [" ".join(f"own{i}" for i in range(80)), " ".join(f"own{i}" for i in range(80)) + " #", None, ""]
    rows = [(i, draw.choice(texts), draw.choice(["s1", "s2", None])) for i in range(200)]
    rows += [(1000 + i, texts[0], "s1") for i in range(40)] + [(7, "a", "s2"), (7, "a", "s2"), (7, texts[0], "s3")]
    rows += [(None, texts[0], "s1"), (None, "", "s1")]
    labels = {i: (draw.randrange(2), draw.randrange(2)) for i in range(0, 1100, 3)}
    return rows, labels


def test_brute_force(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(d, *v) for d, v in labels.items()], "doc_id long, quality int, toxic int")
    want = plain(rows, labels)
    assert found(docs, marks) == want
    assert found(docs, marks, spread=3) == want  # a hot text over several tasks


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = plain([(d, t, "src0") for d, t in ROWS], {})
    assert found(frame(spark), none) == want
    assert A.audit_filters(frame(spark, []), none).collect() == []


def test_labels(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "doc_id long, text string, source string")
    marks = [(1, 1, None, "x"), (1, 0, 1, "x"), (None, 1, 1, "x"), (2, None, None, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, bits string")
    assert found(docs, labels)["s", "ABCDE", 1] == [0, 2, 0, 2, 1, 1, 240]


def test_no_python(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(d, *v) for d, v in labels.items()], "doc_id long, quality int, toxic int")
    plan = A.audit_filters(docs, marks)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
