"""Whitening of embeddings from polarised variances.

Entries become whole numbers, so every sum below is exact. For each dimension
and each sum of two dimensions the tasks add up squared centred values; half
the difference ``Var(a + b) - Var(a) - Var(b)`` is the covariance of a and b.
The assembled matrix goes to ``eigh``; what the driver holds is bounded by the
square of the dimension, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import empty, slices, staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Vectors worked on at a time in a task.
BLOCK_ROWS = 4096
#: Largest n * (spread of a dimension): sums of two centred values stay within 64 bits.
SPREAD_LIMIT = 1 << 60

_MOMENTS = "length int, k int, n long, s decimal(38,0), low long, high long"
_SQUARES = "k int, s decimal(38,0)"
_PARTS = "i int, j int, n long, mi double, mj double, c double"
_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


@dataclass
class Fit:
    """Exact sums over the fit list and the components that follow from them."""

    length: int
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray  # one component per column
    explained: list[float | None]

    @property
    def live(self) -> np.ndarray:
        """Components with variance (the others have no scale to divide by)."""
        e = self.eigenvalues
        return e > max(float(e[0]), 0.0) * len(e) * np.finfo(float).eps if len(e) else np.zeros(0, bool)


def _whole_numbers(batch, length: int | None = None):
    """Usable vectors of an Arrow batch as ``(length, row numbers, x)``, x = floor(64 c) + 1000000."""
    lists = batch.column(1)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    usable = flat.is_valid().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    usable &= np.isfinite(values)
    bad = np.concatenate(([0], np.cumsum(~usable)))
    end = np.cumsum(sizes)
    start = end - sizes
    fine = (bad[end] == bad[start]) & (sizes > 0)
    for size in np.unique(sizes[fine]) if length is None else [length]:
        rows = np.flatnonzero(fine & (sizes == size))
        if len(rows):
            with np.errstate(over="ignore"):
                x = np.floor(values[start[rows][:, None] + np.arange(size)] * float(SCALE))
            if np.abs(x).max() >= 2.0 ** 61:
                raise ValueError("an entry is too large for exact 64-bit sums")
            yield int(size), rows, x.astype(np.int64) + SHIFT


def _exact(a: np.ndarray) -> np.ndarray:
    """Sums over the last axis as Python integers."""
    return ((a >> 32).sum(-1).astype(object) * (1 << 32)) + (a & 0xFFFFFFFF).sum(-1).astype(object)


def _square_sums(s: np.ndarray) -> np.ndarray:
    """Sums of squares over the last axis as Python integers; |s| < 2**61."""
    top = int(np.abs(s).max()) if s.size else 0
    if top * top * s.shape[-1] < 1 << 63:
        return np.einsum("ij,ij->i", s, s).astype(object)
    a, b = s >> 31, s & 0x7FFFFFFF
    return _exact(a * a) * (1 << 62) + _exact(a * b) * (1 << 32) + _exact(b * b)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact, without leaving 64 bits on the way."""
    near = [s // n for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, near)], dtype=np.int64)
    return (x - np.array(near, dtype=np.int64)) * n - rest


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _moments(batches):
    kept: dict[int, list] = {}
    for batch in slices(batches, BLOCK_ROWS):
        for size, _, x in _whole_numbers(batch):
            new = [len(x), _exact(x.T), x.min(0), x.max(0)]
            old = kept.get(size)
            kept[size] = new if old is None else [old[0] + new[0], old[1] + new[1], np.minimum(old[2], new[2]), np.maximum(old[3], new[3])]
    for size, (n, s, low, high) in kept.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n, np.int64)),
             _decimals(s), pa.array(low), pa.array(high)], names=["length", "k", "n", "s", "low", "high"])


def _squares(length: int, n: int, sums: list[int]):
    """Squares of every centred dimension and of every sum of two, added up per task."""
    def run(batches):
        totals = [np.zeros(length - i, dtype=object) for i in range(length)]
        for batch in slices(batches, BLOCK_ROWS):
            for _, _, x in _whole_numbers(batch, length):
                y = np.ascontiguousarray(_centred(x, n, sums).T)
                for i in range(length):
                    s = y[i:] + y[i]
                    s[0] = y[i]
                    totals[i] = totals[i] + _square_sums(s)
        flat = np.concatenate(totals)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), _decimals(flat)], names=["k", "s"])
    return run


def _plain(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Exact covariances of all usable vectors and their leading components; None if there is no vector.

    Usable vectors are not null, not empty and hold finite entries only.
    Should lengths differ, the commonest counts (of equally common ones the
    longer), as there is no covariance across lengths.
    """
    plain = _plain(df, id_col, vector_col)
    sums = plain.mapInArrow(_moments, _MOMENTS).groupBy("length", "k").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sums.collect()  # one row per dimension
    if not rows:
        return None
    n, length = max((r.n, r.length) for r in rows)
    rows = sorted((r for r in rows if r.length == length), key=lambda r: r.k)
    if n * max(r.high - r.low for r in rows) >= SPREAD_LIMIT:
        raise ValueError("entries are too far apart for exact 64-bit sums over so many vectors")
    s = [int(r.s) for r in rows]
    squares = plain.mapInArrow(_squares(length, n, s), _SQUARES).groupBy("k").agg(F.sum("s").alias("s"))
    q = {r.k: int(r.s) for r in squares.collect()}  # one row per pair of dimensions
    at = [[0] * length for _ in range(length)]
    for k, (i, j) in enumerate((i, j) for i in range(length) for j in range(i, length)):
        at[i][j] = q[k]
    cube = n ** 3
    v = np.empty((length, length))
    for i in range(length):
        for j in range(i, length):
            shared = at[i][i] if i == j else (at[i][j] - at[i][i] - at[j][j]) // 2
            v[i, j] = v[j, i] = shared / cube  # the division of two integers rounds once
    trace = sum(at[i][i] for i in range(length))
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    explained = [max(float(x), 0.0) / (trace / cube) if trace else None for x in e]
    return Fit(length, n, s, e, u, explained)


def _projection(model: Fit) -> np.ndarray:
    scale = np.sqrt(np.where(model.live, model.eigenvalues, 1.0))
    return model.vectors / scale


def _comoments(model: Fit):
    """Count, means and centred products of the whitened columns of a task (blocks merged pairwise)."""
    project, live = _projection(model), model.live

    def run(batches):
        n, mean, c = 0, None, None
        for batch in slices(batches, BLOCK_ROWS):
            for _, _, x in _whole_numbers(batch, model.length):
                w = (_centred(x, model.n, model.sums) / model.n) @ project[:, live]
                m = w.mean(0)
                d = w - m
                if n == 0:
                    n, mean, c = len(w), m, d.T @ d
                    continue
                step, both = m - mean, n + len(w)
                c = c + d.T @ d + np.outer(step, step) * (n * len(w) / both)
                mean, n = mean + step * (len(w) / both), both
        if n and len(mean):
            i, j = np.triu_indices(len(mean))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(np.full(len(i), n, np.int64)),
                 pa.array(mean[i]), pa.array(mean[j]), pa.array(c[i, j])], names=["i", "j", "n", "mi", "mj", "c"])
    return run


def identity_error(df: DataFrame, model: Fit, id_col: str = "vec_id", vector_col: str = "embedding") -> float | None:
    """Largest absolute entry of (covariance of the whitened vectors - identity), measured on all of them."""
    parts = staged(_plain(df, id_col, vector_col).mapInArrow(_comoments(model), _PARTS), "whitened-parts")
    means = dict(parts.where("i = j").groupBy("i").agg(F.sum(F.col("n") * F.col("mi")) / F.lit(float(model.n))).collect())
    if not means:
        return None
    mean = F.array(*[F.lit(float(means[i])) for i in range(len(means))])
    shared = F.col("n") * (F.col("mi") - mean[F.col("i")]) * (F.col("mj") - mean[F.col("j")])
    cov = parts.groupBy("i", "j").agg((F.sum(F.col("c") + shared) / F.lit(float(model.n))).alias("v"))
    return cov.select(F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]


def _whiten(model: Fit, error: float | None):
    project, live = _projection(model), model.live
    k = project.shape[1]

    def run(batches):
        for batch in slices(batches, BLOCK_ROWS):
            for _, rows, x in _whole_numbers(batch, model.length):
                y = _centred(x, model.n, model.sums)
                w = (y / model.n) @ project
                deviation = [int(v) if v < 1 << 63 else None for v in _square_sums(y)]
                many = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                     pa.array(np.full(many * k, model.n, np.int64)),
                     pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(many), k))),
                     pa.array(w.ravel(), mask=np.tile(~live, many)), pa.array(model.explained * many, pa.float64()),
                     pa.array([error] * (many * k), pa.float64())], names=[c.split()[0] for c in _OUT.split(", ")])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable vector, one row per vector and component.

    Returns ``vec_id, component, n, deviation, whitened, explained,
    identity_error``. Null, empty and non-finite vectors are dropped, null ids
    and repeated rows stay (a repeated row counts as often as it stands);
    vectors of another length than the commonest are dropped. A component
    without variance (all vectors alike, or fewer vectors than dimensions) has
    null ``whitened`` and no part in ``identity_error``; ``explained`` is null
    where nothing varies at all. ``deviation`` is null where it leaves 64 bits;
    entries too large for exact 64-bit sums are an error. An empty table gives
    no rows. Other columns are not read, whatever their names.
    """
    model = fit(df, id_col, vector_col, components)
    if model is None:
        return empty(df.sparkSession, _OUT)
    error = identity_error(df, model, id_col, vector_col)
    return _plain(df, id_col, vector_col).mapInArrow(_whiten(model, error), _OUT)
