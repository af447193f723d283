"""Vectors of Arrow batches as matrices, their moments by streaming updates, and symmetric eigenproblems."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .blocks import tidy

#: Rows of partial moments that one task merges.
FAN = 64
#: Rows of a matrix that are worked on at a time.
BLOCK_ROWS = 4096
PARTIAL = "n long, total array<string>, mean array<double>, m2 array<double>"


def common_length(rows: DataFrame, vec_col: str) -> int:
    """The most frequent length of vectors that aren't empty (of several, the largest); 0 without any."""
    lengths = rows.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("n")).filter("d > 0")
    best = lengths.agg(F.max(F.struct("n", "d"))["d"]).first()[0]
    return int(best or 0)


def matrix(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, X): places of the vectors that have d entries, all of them finite numbers, and these as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == d)
    values = column.take(pa.array(at)).flatten().cast(pa.float64())
    x = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False).reshape(len(at), d)
    whole = np.isfinite(x).all(1)
    return (at, x) if whole.all() else (at[whole], x[whole])


class Moments:
    """Number, mean and centred second moments of rows that come one after another (Welford).

    A row x that is the k-th changes the mean by (x - mean) / k and adds (k - 1) / k * (x - mean)(x - mean)' to m2, with the mean
    before it.  The rank-one updates of a block are summed by one matrix product, after the running means of its rows.
    """

    def __init__(self, d: int):
        self.n, self.mean, self.m2 = 0, np.zeros(d), np.zeros((d, d))

    def add(self, x: np.ndarray) -> None:
        for lo in range(0, len(x), BLOCK_ROWS):
            rows = x[lo : lo + BLOCK_ROWS]
            # Differences from the mean so far keep running sums small, whatever the origin.
            off = rows - self.mean
            k = np.arange(self.n + 1, self.n + len(rows) + 1, dtype=float)[:, None]
            after = np.cumsum(off, 0) / k
            before = np.zeros_like(off)
            before[1:] = after[:-1]
            delta = off - before
            self.m2 += (delta * ((k - 1) / k)).T @ delta
            self.mean = self.mean + after[-1]
            self.n += len(rows)

    def merge(self, n: int, mean: np.ndarray, m2: np.ndarray) -> None:
        """The parallel update: moments of both sets of rows together."""
        if not n:
            return
        delta, both = mean - self.mean, self.n + n
        self.m2 += m2 + np.outer(delta, delta) * (self.n * n / both)
        self.mean = self.mean + delta * (n / both)
        self.n = both

    def covariance(self) -> np.ndarray:
        return self.m2 / max(self.n, 1)


def moments(rows: DataFrame, d: int, read: Callable[[pa.RecordBatch], np.ndarray], exact: bool = False) -> tuple[Moments, list[int]]:
    """Moments of read(batch) over all batches, a partition at a time, merged in tasks of FAN partials; with exact, the sums of its integers.

    What comes to the driver is one row of d * d numbers.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = Moments(d), [0] * (d if exact else 0)
        for batch in batches:
            x = read(batch)
            found.add(x.astype(float))
            if exact and len(x):
                few = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
                total = [a + int(b) for a, b in zip(total, (x if few else x.astype(object)).sum(0), strict=True)]
        if found.n:
            yield _partial(found, total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = Moments(d), [0] * (d if exact else 0)
        for batch in batches:
            for i in range(batch.num_rows):
                n, sums, mean, m2 = (batch.column(j)[i] for j in range(4))
                found.merge(n.as_py(), np.asarray(mean.values), np.asarray(m2.values).reshape(d, d))
                total = [a + int(b) for a, b in zip(total, sums.as_py(), strict=True)]
        if found.n:
            yield _partial(found, total)

    parts = rows.rdd.getNumPartitions()
    out = rows.mapInArrow(tidy(partial), PARTIAL)
    while parts > 1:
        parts = -(-parts // FAN)
        out = out.repartition(parts).mapInArrow(tidy(merged), PARTIAL)
    row, result = out.first(), Moments(d)
    if row is None:
        return result, [0] * (d if exact else 0)
    result.n, result.mean, result.m2 = row["n"], np.array(row["mean"]), np.array(row["m2"]).reshape(d, d)
    return result, [int(v) for v in row["total"]]


def _partial(found: Moments, total: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([found.n], pa.int64()), pa.array([[str(v) for v in total]], pa.list_(pa.string())),
        pa.array([found.mean.tolist()], pa.list_(pa.float64())), pa.array([found.m2.ravel().tolist()], pa.list_(pa.float64())),
    ], ["n", "total", "mean", "m2"])


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, beside it, rows of Q) with Q a Q' tridiagonal, by Householder reflections."""
    a, d = a.copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if not np.any(v[1:]):
            continue
        head = -np.copysign(length, v[0])
        v[0] -= head
        v /= np.linalg.norm(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = head
        q[k + 1 :] -= 2 * np.outer(v, v @ q[k + 1 :])
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def symmetric_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of a symmetric matrix, values falling: tridiagonal form, then implicit QR steps with Wilkinson's shift.

    Of each vector the entry of largest size is positive.
    """
    scale = float(np.abs(a).max()) if a.size else 0.0
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    diag, off, q = tridiagonal((a + a.T) / (2 * scale))
    eps, hi = np.finfo(float).eps, len(diag) - 1
    while hi > 0:
        small = np.abs(off[:hi]) <= eps * (np.abs(diag[:hi]) + np.abs(diag[1 : hi + 1]))
        off[:hi][small] = 0
        if off[hi - 1] == 0:
            hi -= 1
            continue
        zeros = np.flatnonzero(off[: hi - 1] == 0)
        lo = int(zeros[-1]) + 1 if len(zeros) else 0
        t = (diag[hi - 1] - diag[hi]) / 2
        shift = diag[hi] - off[hi - 1] ** 2 / (t + np.copysign(np.hypot(t, off[hi - 1]), t))
        x, z = diag[lo] - shift, off[lo]
        for k in range(lo, hi):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > lo:
                off[k - 1] = r
            p, e, w = diag[k], off[k], diag[k + 1]
            diag[k], diag[k + 1] = c * c * p + 2 * c * s * e + s * s * w, s * s * p - 2 * c * s * e + c * c * w
            off[k] = c * s * (w - p) + (c * c - s * s) * e
            q[k], q[k + 1] = c * q[k] + s * q[k + 1], c * q[k + 1] - s * q[k]
            x = off[k]
            if k < hi - 1:
                z, off[k + 1] = s * off[k + 1], c * off[k + 1]
    order = np.argsort(-diag, kind="stable")
    q = q[order]
    q *= np.where(q[np.arange(len(q)), np.abs(q).argmax(1)] < 0, -1.0, 1.0)[:, None]
    return diag[order] * scale, q
