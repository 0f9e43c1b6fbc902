"""Whitening of embeddings by an incremental eigendecomposition.

A vector's entries c, as doubles, become the longs ``floor(256 * c)``.  The fit
list is each distinct such vector once: n vectors with per-dimension sums S.  The
components are the unit eigenvectors of its covariance V (divisor n), numbered
from 1 by falling eigenvalue.

1. Each task keeps mean, eigenvalues and eigenvectors of the scatter of its rows.
   A row is a centred rank-one update: with the row's coordinates z in the
   eigenvectors, the new eigenvalues are the roots of the secular equation
   ``1 + rho * sum(z_j^2 / (d_j - x)) = 0``, found for all of them at once by
   rational interpolation inside brackets.  Coordinates near zero, and all but
   one of each group of equal eigenvalues, are deflated first.  Vectors come from
   the coordinates that belong exactly to the roots found, so they stay
   orthogonal.
2. Spectra are combined, ``FAN`` at a time, level by level: each eigenpair of one
   is a rank-one update of the other, and so is the difference of the means.
3. The basis found is refined by one Rayleigh-Ritz step over all rows: V is
   projected on the basis in the tasks, from centred rows, and the small matrix's
   eigenvectors turn the basis.  The result has double precision however good the
   incremental basis was.

Only matrices of the vectors' dimension go through the driver.  Rows whose vector
is null, empty or holds null or non-finite entries are dropped, and so are those
of another length than most distinct vectors have (the longer on ties).  Every
remaining row, repeated ones too, gives one row per component.  A component
without variance has null ``whitened``; ``explained`` and ``identity_error`` are
null if no component has any.  ``deviation`` is null beyond the range of a long.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm import text as T
from kassa.llm.store import save

SCALE = 256
COMPONENTS = 4
FAN = 32
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of the secular equation for rising distinct ``d``, non-zero ``z`` and
    positive ``rho``: the differences ``d_j - root_i`` as a matrix [i, j], and the
    roots."""
    k = len(d)
    weight = rho * z * z
    right = np.append(d[1:], d[-1] + weight.sum())
    gap = right - d
    rows = np.arange(k)
    # measure from the nearer pole; beyond the last pole there is only the left one
    half = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        upper = 1 + (weight / (d - half[:, None])).sum(1) < 0
    upper[-1] = False
    origin = np.where(upper, right, d)
    delta = d - origin[:, None]
    low = np.where(upper, -gap / 2, 0.0)
    high = np.where(upper, 0.0, gap / 2)
    high[-1] = gap[-1]
    x = (low + high) / 2
    below = (rows[None, :] <= rows[:, None]).astype(float)
    pole = delta[rows, rows]  # the pole to the left, from the origin
    next_pole = np.append(delta[rows[:-1], rows[:-1] + 1], 0.0)
    todo = rows
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(60):
            every = len(todo) == k
            at, under = x[todo], below if every else below[todo]
            diff = (delta if every else delta[todo]) - at[:, None]
            t = weight / diff
            dt = t / diff
            psi, dpsi = np.einsum("ij,ij->i", t, under), np.einsum("ij,ij->i", dt, under)
            phi, dphi = t.sum(1) - psi, np.maximum(dt.sum(1) - dpsi, 0)
            last = todo == k - 1
            phi[last] = dphi[last] = 0
            f = 1 + psi + phi
            low[todo] = np.where(f < 0, at, low[todo])
            high[todo] = np.where(f > 0, at, high[todo])
            # 1 + psi + phi is about c + s / (a - y) + big / (b - y) for a step y
            a, b = pole[todo] - at, next_pole[todo] - at
            s, big = dpsi * a * a, dphi * b * b
            c = 1 + (psi - dpsi * a) + (phi - dphi * b)
            q = c * (a + b) + s + big
            r = c * a * b + s * b + big * a
            root = np.sqrt(np.maximum(q * q - 4 * c * r, 0))
            y = np.where(q > 0, 2 * r / (q + root), (q - root) / (2 * c))
            y = np.where(last, a + s / c, y)
            more = np.abs(f) > 8 * _EPS * (1 + np.abs(psi) + np.abs(phi))
            more &= ~(np.abs(y) <= 2 * _EPS * np.abs(at)) & (high[todo] - low[todo] > 2 * _EPS * np.abs(at))
            new = at + y
            new = np.where((new > low[todo]) & (new < high[todo]), new, (low[todo] + high[todo]) / 2)
            x[todo] = np.where(more, new, at)
            todo = todo[more]
            if len(todo) == 0:
                break
    return delta - x[:, None], origin + x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of
    ``vectors @ diag(values) @ vectors.T + rho * v @ v.T``."""
    z = vectors.T @ v
    size = rho * float(z @ z)
    if not size > 0:
        return values, vectors
    scale = max(float(np.abs(values).max()), size)
    # equal eigenvalues: turn their vectors so that one alone has a coordinate
    cut = np.flatnonzero(np.diff(values) > 8 * _EPS * scale) + 1
    starts, ends = np.append(0, cut), np.append(cut, len(values))
    if len(starts) < len(values):
        vectors = vectors.copy()
        z = z.copy()
        for i, j in zip(starts, ends, strict=True):
            if j - i > 1:
                part = z[i:j]
                length = np.linalg.norm(part)
                if length == 0:
                    continue
                mirror = part.copy()
                mirror[-1] += np.copysign(length, part[-1])
                mirror /= np.linalg.norm(mirror)
                vectors[:, i:j] -= np.outer(2 * (vectors[:, i:j] @ mirror), mirror)
                z[i : j - 1] = 0
                z[j - 1] = -np.copysign(length, part[-1])
    live = np.flatnonzero(rho * z * z > (_EPS * _EPS) * scale)
    live = live[np.abs(z[live]) * np.sqrt(rho * size) > _EPS * scale]
    if len(live) == 0:
        return values, vectors
    d, y = values[live], z[live]
    diff, roots = secular_roots(d, y, rho)  # diff[i, j] = d_j - root_i
    # the coordinates that these roots belong to exactly
    k = len(d)
    spread = d[:, None] - d[None, :]
    spread[np.arange(k), np.arange(k)] = 1.0
    # of -diff[i, j] / spread[i, j] over i the sign is positive for every j
    ratio = -diff / spread
    ratio[np.arange(k), np.arange(k)] = -diff[np.arange(k), np.arange(k)]
    exact = np.sqrt(np.abs(np.prod(ratio, axis=0)) / rho)
    turn = (np.copysign(exact, y) / diff).T
    turn /= np.linalg.norm(turn, axis=0)
    out_values, out_vectors = values.copy(), vectors.copy()
    out_values[live] = roots
    out_vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(out_values, kind="stable")
    return out_values[order], out_vectors[:, order]


class Spectrum:
    """Number, exact sums, mean, eigenvalues and eigenvectors of the scatter."""

    def __init__(self, dim: int):
        self.n = 0
        self.sums = np.zeros(dim, np.int64)
        self.mean = np.zeros(dim)
        self.values = np.zeros(dim)
        self.vectors = np.eye(dim)

    def add(self, row: np.ndarray) -> None:
        off = row - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.sums += row
        self.mean += off / self.n

    def combine(self, other: Spectrum) -> None:
        n = self.n + other.n
        off = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self.n = n
        self.sums += other.sums
        self.mean += off * (other.n / n)

    def pack(self) -> bytes:
        head = np.append(self.n, self.sums).astype(np.int64)
        return head.tobytes() + self.mean.tobytes() + self.values.tobytes() + self.vectors.tobytes()

    @staticmethod
    def unpack(raw: bytes, dim: int) -> Spectrum:
        out = Spectrum(dim)
        head = np.frombuffer(raw, np.int64, dim + 1)
        rest = np.frombuffer(raw, np.float64, offset=8 * (dim + 1)).copy()
        out.n, out.sums = int(head[0]), head[1:].copy()
        out.mean, out.values = rest[:dim], rest[dim : 2 * dim]
        out.vectors = rest[2 * dim :].reshape(dim, dim)
        return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


_PART = "id long, state binary"


def _per_task(dim: int, start: Callable, step: Callable, finish: Callable):
    """One row a task: ``step(state, rows)`` over its matrices of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for batch in batches:
            rows = _matrix(batch.column(0), dim)
            for i in range(0, len(rows), 4096):
                state = step(state, rows[i : i + 4096])
                seen = True
        if seen:
            row = {"id": [TaskContext.get().partitionId()], "state": [finish(state)]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("id", pa.int64()), ("state", pa.binary())]))

    return run


def _fold(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """Merge the states ``FAN`` at a time until one is left."""
    import pandas as pd

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        return pd.DataFrame({"id": [int(key[0])], "state": [merge(list(rows["state"]))]})

    while True:
        slot = F.floor(F.col("id") / FAN).alias("slot")
        parts = save(parts.groupBy(slot).applyInPandas(merged, _PART), "spectra")
        top = parts.agg(F.max("id")).first()[0]
        if top is None:
            return None
        if top == 0:
            return bytes(parts.first()["state"])


def _add_rows(state: Spectrum, rows: np.ndarray) -> Spectrum:
    for row in rows:
        state.add(row)
    return state


def spectrum(fit_list: DataFrame, dim: int) -> Spectrum | None:
    """Steps 1 and 2 over a column of arrays of longs."""
    parts = fit_list.mapInArrow(_per_task(dim, lambda: Spectrum(dim), _add_rows, Spectrum.pack), _PART)

    def merge(states: list[bytes]) -> bytes:
        total = Spectrum.unpack(states[0], dim)
        for raw in states[1:]:
            total.combine(Spectrum.unpack(raw, dim))
        return total.pack()

    raw = _fold(parts, merge)
    return None if raw is None else Spectrum.unpack(raw, dim)


def _gram(fit_list: DataFrame, dim: int, turn: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``y.T @ y`` over all rows, y being the turned rows."""

    def step(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
        y = turn(rows)
        return state + y.T @ y

    parts = fit_list.mapInArrow(_per_task(dim, lambda: np.zeros((size, size)), step, np.ndarray.tobytes), _PART)

    def merge(states: list[bytes]) -> bytes:
        return sum(np.frombuffer(s, np.float64) for s in states).tobytes()

    return np.frombuffer(_fold(parts, merge), np.float64).reshape(size, size)


def _whole(entries: str) -> F.Column:
    """Entries as longs."""
    return F.transform(entries, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): rows with a vector of finite entries, as longs."""
    sound = F.forall(
        vector_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    kept = rows.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(F.coalesce(sound, F.lit(False)))
    return kept.select(F.col(id_col).alias("id"), _whole(vector_col).alias("x"))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, component (int), n, deviation (long), whitened, explained and
    identity_error (double) for every usable row and component."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    out = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    usable_rows = usable(rows, id_col, vector_col)
    fit_list = save(usable_rows.select("x").distinct(), "vectors")
    sizes = fit_list.groupBy(F.size("x").alias("size")).count()
    common = sizes.agg(F.max(F.struct("count", "size")).alias("most")).first()["most"]
    if common is None:
        return spark.createDataFrame([], out)
    dim = common["size"]
    fit_list = fit_list.where(F.size("x") == dim)
    found = spectrum(fit_list, dim)
    n, sums, basis = found.n, found.sums, found.vectors

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    ritz = _gram(fit_list, dim, lambda x: centred(x) @ basis, dim) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    first = min(COMPONENTS, dim)
    values, axes = values[::-1][:first], (basis @ turn)[:, ::-1][:, :first]
    trace = float(np.trace(ritz))
    sound = values > 4 * dim * _EPS * trace
    factor = np.zeros(first)
    factor[sound] = 1 / np.sqrt(values[sound])
    axes = axes / np.linalg.norm(axes, axis=0) * factor
    explained = [float(e) / trace if trace > 0 else None for e in values]
    error = None
    if sound.any():
        unit = _gram(fit_list, dim, lambda x: centred(x) @ axes[:, sound], int(sound.sum())) / n
        error = float(np.abs(unit - np.eye(len(unit))).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x = _matrix(part.column(1), dim)
                off = n * x - sums
                far = (off.astype(np.float64) ** 2).sum(1) > 9.2e18
                deviation = (off * off).sum(1)  # exact modulo 2**64, so exact where it fits
                whitened = centred(x) @ axes
                m = len(x)
                repeat = np.repeat(np.arange(m), first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(repeat)),
                        pa.array(np.tile(np.arange(1, first + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * first, n, np.int64)),
                        pa.array(deviation[repeat], mask=far[repeat]),
                        pa.array(whitened.ravel(), mask=np.tile(~sound, m)),
                        pa.array(explained * m, pa.float64()),
                        pa.array([error] * (m * first), pa.float64()),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )
        T.give_back()

    return usable_rows.where(F.size("x") == dim).mapInArrow(project, out)
