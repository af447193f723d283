"""Whitening of embeddings: streaming moments, principal axes, unit variance along each.

Entries c become integers floor(1024 c) + 100000, so sums are exact however rows are dealt.  Each partition keeps a
number, a mean and a matrix by Welford's rank-one updates; partials merge by the parallel formula in a tree of tasks, and
one matrix comes to the driver, whose eigenvectors are found by the symmetric QR algorithm.  A second pass measures the
covariance of what was whitened.

Rows whose vector is null, empty or holds a null, a NaN or an infinity are dropped, and so are vectors of another
length than the most frequent one (of two as frequent, the larger).  A null id is kept.  Repeated rows count each.
Integers beyond 2 ** 62 in size stand at that bound.  Without spread along an axis (one row, equal rows, dependent
entries) there is nothing to divide by: `whitened` is null there, and `identity_error` is taken over the other axes,
0 without any.  With fewer entries than components, there are as many components as entries.  An empty
table gives an empty result.  Other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .blocks import tidy
from .common import table
from .vectors import common_length, matrix, moments, symmetric_eigen

COMPONENTS = 8
SCALE, ORIGIN = 1024, 100_000
MOST = 1 << 62
#: Variance along an axis, as a share of all, that counts as none for each entry of a vector.
NO_SPREAD = 1e-13


def integers(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * SCALE), -float(MOST), float(MOST - 2 * ORIGIN)).astype(np.int64) + ORIGIN


@dataclass
class Whitening:
    n: int
    total: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - total, exact: of 64 bits where that can hold it, of any size otherwise."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max((abs(t) for t in self.total), default=0)
        if bound < 1 << 62:
            return self.n * x - np.array(self.total, np.int64)
        return self.n * x.astype(object) - np.array(self.total, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.variances > 0, 1 / np.sqrt(self.variances), np.nan)
        return (centred.astype(float) / self.n) @ self.axes.T * scale


def fit(rows: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors of a table; None where there are none."""
    d = common_length(rows, vec_col)
    if not d:
        return None
    found, total = moments(rows.select(vec_col), d, lambda batch: integers(matrix(batch.column(0), d)[1]), exact=True)
    if not found.n:
        return None
    values, axes = symmetric_eigen(found.covariance())
    trace = max(float(np.trace(found.covariance())), 0.0)
    values = np.where(values > NO_SPREAD * d * trace, values, 0.0)
    k = min(components, d)
    return Whitening(found.n, total, axes[:k], values[:k], values[:k] / trace if trace else np.zeros(k))


def squares(centred: np.ndarray) -> pa.Array:
    """Sums of squares of the rows, exact, as decimals."""
    if centred.dtype != object:
        most = int(np.abs(centred).max(initial=0))
        if most * most * max(centred.shape[1], 1) < 1 << 63:
            return pa.array((centred * centred).sum(1)).cast(pa.decimal128(38, 0))
    from decimal import Decimal

    wide = centred.astype(object)
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in (wide * wide).sum(1)], pa.decimal128(38, 0))


def identity_error(rows: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of what is whitened, minus the identity."""
    d, spread = model.axes.shape[1], model.variances > 0
    if not spread.any():
        return 0.0
    found, _ = moments(rows.select(vec_col), int(spread.sum()), lambda batch: model.whitened(model.centred(integers(matrix(batch.column(0), d)[1])))[:, spread])
    return float(np.abs(found.covariance() - np.eye(int(spread.sum()))).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component from 1.

    deviation is the exact sum of the squares of n * x - total, a decimal of 38 digits; null beyond.
    """
    kind = dict(rows.dtypes)[id_col]
    shape = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(rows, vec_col, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], shape)
    d, k, error = model.axes.shape[1], len(model.axes), identity_error(rows, model, vec_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = matrix(batch.column(1), d)
            if not len(at):
                continue
            centred = model.centred(integers(x))
            w = model.whitened(centred)
            each = pa.array(np.repeat(np.arange(len(at)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(at) * k, model.n)),
                squares(centred).take(each), pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(np.tile(model.explained, len(at))), pa.array(np.full(len(at) * k, error)),
            ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).mapInArrow(tidy(run), shape)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened", "explained", "identity_error")
