"""Whitening against numpy's eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest

from kassa.llm import whitening as W

SF001 = "/root/testdata/sf0.001"


def plain(rows):
    """rows: (vec_id, list) -> {(vec_id, component): (n, deviation, whitened, explained)}."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    longs = [(i, [math.floor(256 * c) for c in v]) for i, v in good]
    fit = np.array(sorted({tuple(x) for _, x in longs}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = ((n * fit - sums) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in longs:
        off = n * np.array(x, dtype=object) - sums
        for k in range(min(4, len(sums))):
            white = (off / n).astype(float) @ axes[:, k] / math.sqrt(values[k]) if values[k] > 1e-9 else None
            out[i, k + 1] = (n, int((off * off).sum()), white, values[k] / values.sum())
    return out


def compare(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want)
    signs = {}
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9, abs=1e-12)
        assert r.identity_error is None or r.identity_error < 1e-6
        if white is None:
            assert r.whitened is None
        elif abs(white) > 1e-6:
            sign = signs.setdefault(r.component, math.copysign(1, white * r.whitened))
            assert r.whitened * sign == pytest.approx(white, rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("seed", range(12))
def test_rank_one(seed):
    draw = np.random.default_rng(seed)
    dim = int(draw.integers(1, 20))
    values = np.sort(draw.choice([0.0, 1.0, 1.0 + 1e-15, 2.0, 5.0, 1e-9, 1e9], dim) if seed % 2 else draw.random(dim))
    vectors = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
    v = vectors @ (draw.normal(size=dim) * (draw.random(dim) < 0.7))
    rho = float(draw.choice([1e-3, 1.0, 1e4]))
    got, basis = W.rank_one(values, vectors, v, rho)
    whole = vectors @ np.diag(values) @ vectors.T + rho * np.outer(v, v)
    scale = max(np.abs(whole).max(), 1e-300)
    assert np.abs(basis.T @ basis - np.eye(dim)).max() < 1e-12
    assert np.abs(basis @ np.diag(got) @ basis.T - whole).max() < 1e-12 * scale * dim
    assert np.all(np.diff(got) >= 0)


def test_spectrum_of_parts_is_that_of_the_whole():
    draw = np.random.default_rng(3)
    rows = np.floor(draw.normal(size=(400, 12)) * np.arange(1, 13) * 20).astype(np.int64)
    rows[:, 5] = rows[:, 4]  # a direction without variance
    total = None
    for part in np.array_split(rows, [1, 3, 150]):
        one = W._add_rows(W.Spectrum(12), part)
        if total is None:
            total = one
        else:
            total.combine(W.Spectrum.unpack(one.pack(), 12))
    off = rows - rows.mean(0)
    assert total.n == 400 and total.sums.tolist() == rows.sum(0).tolist()
    want = np.linalg.eigvalsh(off.T @ off)
    assert np.abs(total.values - want).max() < 1e-10 * want.max()


def test_table(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = W.whiten(table.repartition(5)).collect()
    compare(got, plain(rows))


def test_several_levels(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    table = spark.read.parquet(f"{SF001}/embeddings.parquet").limit(40)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(r.vec_id, r.embedding) for r in table.collect()]
        compare(W.whiten(table).collect(), plain(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None),
        (2, []),
        (3, [1.0, None, 0.0]),
        (4, [nan, 0.0, 0.0]),
        (5, [0.0, -inf, 0.0]),
        (6, [-0.0, 0.5, 0.25]),
        (6, [0.0, 0.5, 0.25]),
        (None, [0.0, 0.5, 0.25]),
        (7, [0.3, -0.5, 1e3]),
        (8, [0.1, 0.2, 0.3]),
        (9, [0.11, 0.29, -0.3]),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, x string")
    # floats are read as such: compare with the same values
    sound = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = W.whiten(docs).collect()
    compare(got, plain(sound))
    assert len(got) == 6 * 3
    # another length than most is dropped; nothing left gives nothing
    assert W.whiten(docs.union(spark.createDataFrame([(10, [1.0], "x")], docs.schema))).count() == 18
    assert W.whiten(docs.where("vec_id < 6")).collect() == []
    only = W.whiten(docs.where("vec_id = 6")).collect()
    assert len(only) == 6 and all(r.whitened is None and r.deviation == 0 and r.n == 1 for r in only)
