import zlib

import duckdb
import numpy as np
from llm_cases import ROWS, frame

from kassa.llm import toxicity as X
from kassa.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in X.new_parameters().items()}
    x = rng.normal(size=(5, X.INPUTS, 4))
    live = np.arange(5)[:, None] < np.array([5, 3, 1, 4])[None, :]
    y = np.array([1.0, 0, 1, 0])

    def loss(q):
        logit = X.forward(q, x, live)[0]
        return float(np.sum(np.logaddexp(0, logit) - y * logit))

    logit, held = X.forward(p, x, live, keep=True)
    g = X.backward(p, x, live, held, 1 / (1 + np.exp(-logit)) - y)
    for k, v in p.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in v.shape)
            up, down = dict(p), dict(p)
            up[k], down[k] = v.copy(), v.copy()
            up[k][at] += 1e-3
            down[k][at] -= 1e-3
            assert abs((loss(up) - loss(down)) / 2e-3 - g[k][at]) < 2e-3, k


def test_every_window_is_there():
    size = X.WINDOW
    bounds = np.cumsum([0, 0, 1, size - 1, size, size + 1, 5 * size])
    first, doc = X.windows(bounds)
    got = [(int(d), int(a)) for d, a in zip(doc, first, strict=True)]
    want = []
    for d, (a, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        starts = range(a, e - size + 1) if e - a >= size else [a] if e > a else []
        want += [(d, s) for s in starts]
    assert got == want


def _plain_logit(p, x):
    """One window, step by step: x is INPUTS x words."""
    H = X.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))
    states = np.zeros((x.shape[1], 2 * H))
    for side, order, own in (("f", range(x.shape[1]), slice(0, H)), ("b", reversed(range(x.shape[1])), slice(H, 2 * H))):
        h = np.zeros(H)
        W, U = p["W" + side].astype(float), p["U" + side].astype(float)
        for t in order:
            a, b = W @ x[:, t], U @ h
            z, r = sig(a[:H] + b[:H]), sig(a[H : 2 * H] + b[H : 2 * H])
            g = np.tanh(a[2 * H :] + r * b[2 * H :])
            h = (1 - z) * g + z * h
            states[t, own] = h
    s = np.exp(states @ p["v"])
    return float(p["w"] @ (s @ states) / s.sum() + p["c"][0])


def test_scores_equal_a_plain_loop_over_all_windows():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, n)).encode() for n in (0, 1, 5, 23, 24, 25, 60, 300)]
    p = X.new_parameters(3)
    size = 1 << X.BITS
    odds = {k: rng.normal(0, 1, size).astype(np.float32) for k in ("word", "gram")}
    got = X.score_texts({"network": p, "odds": odds}, texts)
    data, first, last, bounds = X._parted(texts)
    x = X.features(data, first, last, odds)
    for i in range(len(texts)):
        a, e = int(bounds[i]), int(bounds[i + 1])
        if a == e:
            assert got[i] == 0
            continue
        best = max(_plain_logit(p, x[:, s : min(s + X.WINDOW, e)]) for s in range(a, max(a, e - X.WINDOW) + 1))
        assert abs(got[i] - 1 / (1 + np.exp(-best))) < 1e-5
    # blocks of another size give the same
    logit = X.window_scores(p, x, bounds)[0]
    assert np.allclose(logit, X.window_scores(p, x, bounds, part=7)[0], atol=1e-5)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF01).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF01}/labels.parquet'").fetchall()
    n = duckdb.sql(f"SELECT count(*) FROM '{SF01}/documents.parquet'").fetchall()[0][0]
    assert len(got) == n
    right = {0: [], 1: []}
    for doc_id, toxic in labels:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out:
            right[toxic].append(r.predicted == toxic)
    assert np.mean(right[0]) > 0.97 and np.mean(right[1]) > 0.7


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, "a " * X.MAX_TEXT), (2, "bad words"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, toxic int")
    texts, toxic = X.training_sample(docs, labels, 5, 5)
    assert texts == [b"bad words", b""] and toxic.tolist() == [True, False]


def test_edge_rows(spark):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1), (5, None), (7, 1)], "doc_id long, toxic int")
    docs = frame(spark)
    for model in (X.fit(docs, labels), X.fit(docs, labels.where("toxic = 0"))):
        out = X.score(docs, model).collect()
        assert len(out) == len(ROWS)
        assert all(0 <= r.score <= 1 for r in out)
        assert all(r.score == 0 for r in out if r.doc_id in (1, 2, 3))
    assert X.score(frame(spark, []), None).collect() == []
    assert X.fit(frame(spark, []), labels) is None


def test_each_distinct_word_is_looked_up_once():
    rng = np.random.default_rng(5)
    table = rng.normal(0, 1, 1 << X.BITS).astype(np.float32)
    looked = []

    class Counted:
        def __getitem__(self, slots):
            looked.append(len(slots))
            return table[slots]

    words = [b"stable", b"a", "naïve".encode(), b"table", b"stables"]
    picks = rng.integers(0, len(words), 2000)
    data, first, last, _ = X._parted([b" ".join(words[i] for i in picks[:900]), b"", b" ".join(words[i] for i in picks[900:])])
    x = X.features(data, first, last, {"word": Counted(), "gram": Counted()})
    assert sum(looked) < 5 * 50
    alone = [X.features(*X._parted([w])[:3], {"word": table, "gram": table}) for w in words]
    assert np.array_equal(x, np.concatenate([alone[i] for i in picks], axis=1))
