import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ROWS, frame

from kassa.llm import suffix_dedup as S


def brute(rows):
    """doc -> (bytes, removed, runs, hash) by all 50-byte strings."""
    first = {}
    for d, t in sorted(((d, t or "") for d, t in rows if d is not None), key=lambda r: r[0]):
        raw = t.encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d)
    out = {}
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        if d is not None:
            for i in range(len(raw) - 49):
                if first[raw[i : i + 50]] < d:
                    gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows):
    docs = frame(spark, rows)
    got = S.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert r.kept == "x" and r.chunk == "x"  # columns of the input stay


def test_edge_rows(spark):
    check(spark, ROWS)


def test_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", 3000)  # many chunks, so runs are merged
    rng = random.Random(5)
    passages = ["".join(rng.choice("ab é.\n") for _ in range(rng.randrange(40, 140))) for _ in range(12)]
    rows = []
    for d in range(150):
        parts = [
            rng.choice(passages)[rng.randrange(5) :] if rng.random() < 0.5 else "".join(rng.choice("cdefgh ") for _ in range(60))
            for _ in range(rng.randrange(6))
        ]
        rows.append((rng.randrange(10**9) * 1000 + d, "".join(parts)))
    check(spark, rows)


def test_empty_table(spark):
    assert S.remove_repeats(frame(spark, [])).collect() == []


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    passage = rng.integers(97, 101, 50).astype(np.uint8)
    hashes = []
    for before in (0, 7, 333):
        data = np.concatenate([rng.integers(97, 123, before).astype(np.uint8), passage, rng.integers(97, 123, 9).astype(np.uint8)])
        place, h = S.anchors(data, np.zeros(1, int), np.array([len(data)]))
        inside = (place >= before) & (place + S.GRAM <= before + 50)
        hashes.append(set(h[inside].tolist()))
    assert hashes[0] & hashes[1] & hashes[2]


keys = st.lists(st.lists(st.binary(min_size=3, max_size=3), unique=True), min_size=1, max_size=7)


@settings(deadline=None, max_examples=150)
@given(keys)
def test_merge_is_a_sort(runs):
    runs = [sorted(x + bytes(S.KEY - 3) for x in run) for run in runs]
    coded = []
    for run in runs:
        if run:
            common = S._common(np.frombuffer(b"".join(run), np.uint8).reshape(-1, S.KEY))
            rest = b"".join(k[n:] for k, n in zip(run, common.tolist(), strict=True))
            coded.append((common.tolist(), rest))
        else:
            coded.append(([], b""))
    got = list(S.merge(coded))
    assert [key for _, key, _, _ in got] == sorted(k for run in runs for k in run)
    before = b""
    for i, (common, key, run, index) in enumerate(got):
        assert runs[run][index] == key
        if i:
            assert common == next((n for n in range(S.KEY) if key[n] != before[n]), S.KEY)
        before = key
