"""Whole-batch numpy kernels over the UTF-8 buffers of Arrow string columns.

A batch is cut into blocks of whole documents of about a megabyte, so that the
working memory is bounded by the block or, if larger, by one document.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64


def give_back() -> None:
    """Return unused memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def tidy(run):
    """run, a function of Arrow batches, that gives unused memory back at its end: Python workers live on, and what
    one operator once needed would be held through all that follow."""

    def with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return with_end


BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
GRAM = U(0xD6E8FEB86659FD93)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, U)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 1 << 24:
            _powers[str(base)] = have
    return have[:n]


@dataclass
class Block:
    """Documents lo..hi of a column: bytes and the offsets of each document in them."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


def blocks(column: pa.Array, block_bytes: int = 1 << 20) -> Iterator[Block]:
    """Null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1)
        yield Block(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def spans(b: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the maximal runs where inside holds, cut at document ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = b.offsets[:-1][b.offsets[:-1] < b.offsets[1:]]
    before = np.empty_like(inside)
    before[1:] = ~inside[:-1]
    before[edges] = True
    starts = np.flatnonzero(inside & before)
    last = np.empty_like(inside)
    last[:-1] = ~inside[1:]
    last[-1] = True
    last[edges[1:] - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(b.offsets, starts, "right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run: polynomial in an odd base, then mixed with the length."""
    if not len(starts):
        return np.zeros(0, U)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(BASE_INVERSE, len(data))[starts]
    return mix(h + (ends - starts).astype(U) * GRAM)


def run_sums(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of each run h[lo:hi] of hashes, which depends on their order and number."""
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * powers(BASE, len(h)), out=total[1:])
    return mix((total[hi] - total[lo]) * powers(BASE_INVERSE, len(h) + 1)[lo] + (hi - lo).astype(U) * GRAM)


def words(b: Block, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document, start and end of each word."""
    data = LOWER[b.data] if lower else b.data
    starts, ends, doc = spans(b, ~IS_SPACE[data])
    return run_hashes(data, starts, ends), doc, starts, ends


def grams(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-grams that stay in a document, and the position of each one's first item."""
    if len(h) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    m = len(h) - k + 1
    out = np.zeros(m, U)
    for i in range(k):
        out = out * GRAM + h[i : i + m]
    at = np.flatnonzero(doc[:m] == doc[k - 1 :])
    return mix(out[at]), at


def counts(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, n)


def shingle_sets(b: Block, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles, ASCII letters lower-cased, grouped by document; sizes by document.

    A text with fewer words than k has its whole word sequence as one shingle, a text without words none.
    """
    h, doc, _, _ = words(b, lower=True)
    n_words = counts(doc, b.n)
    g, at = grams(h, doc, k)
    g_doc = doc[at]
    few = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(few):
        first = np.searchsorted(doc, few)
        extra = np.zeros(len(few), U)
        for j in range(k - 1):
            has = n_words[few] > j
            extra[has] = extra[has] * GRAM + h[first[has] + j]
        g = np.concatenate([g, mix(extra + n_words[few].astype(U))])
        g_doc = np.concatenate([g_doc, few])
    order = np.lexsort((g, g_doc))
    g, g_doc = g[order], g_doc[order]
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (g_doc[1:] != g_doc[:-1])
        g, g_doc = g[new], g_doc[new]
    return g, np.bincount(g_doc, minlength=b.n)
