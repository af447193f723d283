"""Hashed n-gram features and the two ways of training a logistic regression on them.

Features are means: a document's score is the bias plus, for each family of n-grams,
the mean weight of its n-grams times a constant.  Training and scoring share the
kernels of blocks.py, so a text has the same features in both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import Block, blocks, grams, mix, tidy, U, words

#: What a family's mean weight is multiplied by.
SCALE = 16.0
#: Features of their own: the end of a text, and a word that follows itself, whichever it is.
END, SAME_TWICE = 0, 1


#: Features of a training text, at most.
ROW_FEATURES = 1 << 14


@dataclass(frozen=True)
class Features:
    """word_bits and char_bits: sizes of the hashed spaces as powers of 2; no char_sizes: words only."""

    word_sizes: tuple[int, ...] = (1, 2)
    char_sizes: tuple[int, ...] = ()
    word_bits: int = 18
    char_bits: int = 16

    @property
    def size(self) -> int:
        return (1 << self.word_bits) + ((1 << self.char_bits) if self.char_sizes else 0)

    def families(self, b: Block, word_table=None):
        """(document, feature) of each n-gram, one pair of arrays for each n."""
        h, doc, _, _ = words(b) if word_table is None else word_table
        for k in self.word_sizes:
            g, at = grams(h, doc, k)
            f = (g >> U(64 - self.word_bits)).astype(np.int64)
            if k == 2:
                f[h[at] == h[at + 1]] = SAME_TWICE
            # The end of each text is an n-gram too, so shares tell how long it is.
            yield np.concatenate([doc[at], np.arange(b.n)]), np.concatenate([f, np.full(b.n, END, np.int64)])
        if self.char_sizes:
            char_doc = np.repeat(np.arange(b.n), np.diff(b.offsets))
            data = b.data.astype(np.uint32)
            for k in self.char_sizes:
                if len(data) < k:
                    continue
                m = len(data) - k + 1
                g = np.full(m, k, np.uint32)
                for i in range(k):
                    g = g * np.uint32(0x01000193) + data[i : i + m]
                g *= np.uint32(0x9E3779B1)
                inside = np.flatnonzero(char_doc[:m] == char_doc[k - 1 :])
                yield char_doc[inside], (g[inside] >> np.uint32(32 - self.char_bits)).astype(np.int64) + (1 << self.word_bits)


def margins(b: Block, features: Features, weights: np.ndarray, bias: float, word_table=None) -> np.ndarray:
    z = np.full(b.n, bias, np.float64)
    for doc, f in features.families(b, word_table):
        n = np.bincount(doc, minlength=b.n)
        z += SCALE * np.bincount(doc, weights[f], b.n) / np.maximum(n, 1)
    return z


def sparse_rows(texts: list[str] | pa.Array, features: Features) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features and their values, by text."""
    out = []
    for b in blocks(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts):
        parts = []
        for doc, f in features.families(b):
            n = np.bincount(doc, minlength=b.n)
            key, c = np.unique(doc * features.size + f, return_counts=True)
            d = key // features.size
            parts.append((d, key % features.size, SCALE * c / n[d]))
        d, f, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        # The end of a text is in every family.
        key, where = np.unique(d * features.size + f, return_inverse=True)
        d, f, v = key // features.size, (key % features.size).astype(np.int32), np.bincount(where, v).astype(np.float32)
        cuts = np.searchsorted(d, np.arange(b.n + 1))
        out += [(f[i:j], v[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train_adagrad(rows, y: np.ndarray, size: int, epochs: int = 12, rate: float = 0.1, l2: float = 1e-5, batch: int = 32, seed: int = 7):
    """Mini-batch gradient steps with a step length by coordinate."""
    w, g2, bias, bias_g2 = np.zeros(size), np.full(size, 1e-6), 0.0, 1e-6
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            part = order[lo : lo + batch]
            f = np.concatenate([rows[i][0] for i in part])
            v = np.concatenate([rows[i][1] for i in part])
            of = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            p = sigmoid(bias + np.bincount(of, w[f] * v, len(part)))
            err = (p - y[part]) / len(part)
            at, where = np.unique(f, return_inverse=True)
            g = np.bincount(where, err[of] * v, len(at)) + l2 * w[at]
            g2[at] += g * g
            w[at] -= rate * g / np.sqrt(g2[at])
            e = err.sum()
            bias_g2 += e * e
            bias -= rate * e / np.sqrt(bias_g2)
    return w, bias


def train_ftrl(rows, y: np.ndarray, size: int, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, seed: int = 7):
    """Follow the regularised leader (proximal), one document at a time; the bias is the last coordinate, unpenalised."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(seed)

    def weights(at):
        s = z[at]
        free = at == size
        w = -(s - np.where(free, 0, np.sign(s) * l1)) / ((beta + np.sqrt(n[at])) / alpha + np.where(free, 0, l2))
        return np.where(free | (np.abs(s) > l1), w, 0.0)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            f, v = np.append(f, size), np.append(v, 1.0)
            w = weights(f)
            g = (sigmoid(w @ v) - y[i]) * v
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / alpha
            z[f] += g - sigma * w
            n[f] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], float(w[size])


def fit_platt(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a, c of sigmoid(a * z + c) by Newton's method on smoothed targets; the identity where one class is absent."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    if not pos or not neg:
        return 1.0, 0.0
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, c = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * z + c)
        d, r = p - t, np.maximum(p * (1 - p), 1e-9)
        g = np.array([d @ z, d.sum()])
        h = np.array([[r @ (z * z) + 1e-6, r @ z], [r @ z, r.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(c)) if a > 0 and np.isfinite([a, c]).all() else (1.0, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, features: Features, max_rows: int, keep=None) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(features and values, labels) of at most max_rows labelled texts, whole ones, chosen by a hash of the id.

    keep: a condition on doc_id.  The ids are broadcast; their number is bounded by max_rows.  Features are
    computed where the texts are, so what comes to the driver has nothing to do with the length of a text:
    of one with more than ROW_FEATURES distinct ones those are taken whose number hashes lowest.
    """
    ids = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
    if keep is not None:
        ids = ids.filter(keep)
    ids = ids.groupBy("doc_id").agg(F.max(label_col).alias("y")).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def run(batches):
        for batch in batches:
            for lo in range(batch.num_rows):
                part = batch.slice(lo, 1)
                ((f, v),) = sparse_rows(part.column(1), features)
                if len(f) > ROW_FEATURES:
                    some = np.sort(np.argsort(mix(f.astype(U)))[:ROW_FEATURES])
                    f, v = f[some], v[some]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([f.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], ["doc_id", "y", "f", "v"])

    rows = found.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("y").cast("double").alias("y"))
    got = rows.mapInArrow(tidy(run), "doc_id string, y double, f binary, v binary").toArrow()
    order = np.argsort(np.array(got.column("doc_id").to_pylist(), object), kind="stable") if len(got) else np.zeros(0, int)
    f, v, y = (got.column(c) for c in ("f", "v", "y"))
    # Views of what came: the driver holds no second copy.
    return [(np.frombuffer(f[i].as_buffer(), np.int32), np.frombuffer(v[i].as_buffer(), np.float32)) for i in order.tolist()], np.array([y[i].as_py() for i in order.tolist()])
