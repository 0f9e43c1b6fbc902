"""Repeated word windows against a plain count of all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest
from llm_cases import LONG, ROWS, frame

from kassa.llm import substring_dedup as S


def plain(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    size = S.WINDOW
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if times[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    done = S.remove_repeated_windows(frame(spark, rows), with_text=False, **options)
    return sorted(
        ((r.doc_id, r["n_words"], r.n_removed, r.kept_sha256) for r in done.collect()), key=repr
    )


def corpus(seed):
    """Shared passages between words of their own, self-repeats, copies."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 3)))
    passages = [[word() for _ in range(draw.choice((9, 34, 35, 36, 80)))] for _ in range(4)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            w += draw.choice(passages) + [word() for _ in range(draw.randint(0, 30))]
        rows.append((i, draw.choice((" ", "\n", "\t ")).join(w)))
    rows.append((60, "la " * 120))
    rows.append((61, " ".join(["a b c d e f g"] * 20)))
    return rows + rows[:5] + [(100 + i, t) for i, t in rows[5:9]]


@pytest.mark.parametrize(("seed", "hot"), [(1, S.HOT), (2, 3), (3, 0)])
def test_brute_force(spark, seed, hot):
    rows = corpus(seed)
    assert found(spark, rows, hot=hot) == plain(rows)


def test_edges(spark):
    assert found(spark, ROWS) == plain(ROWS)
    assert S.remove_repeated_windows(frame(spark, [])).collect() == []


def test_columns_and_text(spark):
    done = S.remove_repeated_windows(frame(spark))
    names = [c for c in frame(spark).columns if c not in ("text", "n_words")]
    assert done.columns == [*names, "n_words", "n_removed", "kept_sha256", "clean_text"]
    for r in done.collect():
        assert r.kept_sha256 == hashlib.sha256(r.clean_text.encode()).hexdigest()
        assert r.chunk == "x"  # a clashing name keeps its values
    by_id = {r.doc_id: r for r in done.collect()}
    assert by_id[8].n_removed == len(LONG.split()) and by_id[9].clean_text == "end"


def test_hot_line_between_own_words(spark):
    """A 20-word line in every text: its minimiser is hot, and is no bucket."""
    draw = random.Random(7)
    line = " ".join(f"hot{i}" for i in range(20))
    own = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(30))
    rows = [(i, f"{own()} {line} {own()}") for i in range(300)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:7])]
    assert found(spark, rows, hot=16) == plain(rows)


def test_texts_stay_where_they_are(spark):
    """Neither join on the chunks shuffles them, and no catalogue entry stays."""
    done = S.remove_repeated_windows(frame(spark))
    plan = done._jdf.queryExecution().executedPlan().toString()
    for scan in plan.split("FileScan parquet")[1:]:
        assert "Bucketed: true" in scan or "body" not in scan.split("]")[0]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kassa_words")]


def test_words_of_a_chunk():
    import numpy as np

    data = np.frombuffer(b"a\t\tbc  dd", np.uint8)
    words = S.Words(data, np.array([0, 3]), np.array([3, 9]))
    assert words.data.tobytes() == b"a bc dd " and words.bounds.tolist() == [0, 1, 3]
