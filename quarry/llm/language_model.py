"""Language-model scores from Elias-Fano n-gram tries.

Model.  Tokens are lower-cased words and one end per text.  Every word of the training
texts and every bigram and trigram that they have ``SEEN`` times or more belong to the
model, at every size of the input: there is no other bound on it.

Counting.  Texts are cut into chunks of megabytes, written as word lists and places
in them.  A chunk sends its distinct n-grams with their counts to shards by the hash of the
n-gram, as one packed row per chunk and shard; a shard adds them up, keeps those seen
often enough, and answers each chunk in the order in which it asked.  It also sums what
its n-grams take of their contexts' mass, which goes to the shards of the level below.
So nothing is gathered on the driver but two sums, and the number of shards follows the
number of tokens.

Smoothing.  Absolute discounting, interpolated: what a context loses to the discount
and to n-grams that weren't kept is its weight of the shorter context.  Unigrams are
(c + 1) / (N + V + 1), for every word.

Trie.  The n-grams of the model that a chunk has form its trie.  Each level has the words
below all contexts as one monotone sequence (a word is stored relative to the last value
of the context before), Elias-Fano coded, and pointers from contexts to their ranges,
Elias-Fano coded.  A lookup is a successor search in the range of its context.

``build`` and ``score`` are the same model as one trie that is broadcast, with 8-bit codes
of probabilities; ``build`` refuses training texts whose model is larger than that may be.

Nulls count as empty texts, which are one end.  A null id belongs to training.  Repeated rows are
counted and scored each.  A very long text is scored as a whole; a chunk holds at least one text.
An empty table gives an empty result.  Extra columns are kept; those named like the result are
replaced.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .blocks import Block, blocks, GRAM, mix, tidy, U, words
from .common import drop_written, fresh, fresh_prefix, table, written

#: Words, and n-grams of a level, that a broadcast trie may have.
VOCABULARY = 1 << 15
LEVEL = 1 << 20
#: An n-gram of two or three words belongs to the model if training texts have it so often.
SEEN = 2
#: Bytes of text in a chunk, tokens in a shard and shards at least.
CHUNK_BYTES = 2 << 20
SHARD_TOKENS, SHARDS = 2_000_000, 48
#: Rounds that a level's shards are asked in, one after the other, so that less lies on disk at once.
ROUNDS = {3: 2, 2: 2, 1: 1}
DISCOUNT = 0.5
END = U(0x1D8E4E27C47D124F)
FOLDS, HELD = 7, 2


# ---- Elias-Fano ---------------------------------------------------------------------------------


@dataclass
class EliasFano:
    """A sequence of n non-negative numbers in ascending order.

    What is stored is low bits and unary high parts; the places of ones and zeros among the latter,
    by which parts are selected, are listed when the sequence is first asked.
    """

    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(U)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (v >> U(bits)).astype(np.int64) + np.arange(n)
        size = (int(places[-1]) if n else 0) + 2
        flags = np.zeros(-(-size // 64) * 64, bool)
        flags[places] = True
        high = np.packbits(flags, bitorder="little").view(U)
        low = np.zeros((n * bits + 63) // 64 + 1, U)
        if bits:
            rest = v & U((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, off = at >> 6, (at & 63).astype(U)
            np.bitwise_or.at(low, word, rest << off)
            over = np.flatnonzero((at & 63) + bits > 64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (U(64) - off[over]))
        return cls(n, bits, low, high)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U)
        at = i * self.bits
        word, off = at >> 6, (at & 63).astype(U)
        x = self.low[word] >> off
        more = np.where(off > 0, self.low[np.minimum(word + 1, len(self.low) - 1)] << ((U(64) - off) & U(63)), U(0))
        return (x | more) & U((1 << self.bits) - 1)

    @cached_property
    def selected(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the ones and of the zeros."""
        flags = np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little").view(bool)
        return np.flatnonzero(flags), np.flatnonzero(~flags)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return ((self.selected[0][i] - i).astype(U) << U(self.bits)) | self.lows(i)

    def _before(self, h: np.ndarray) -> np.ndarray:
        """How many values have a high part below h."""
        j = np.maximum(h - 1, 0)
        return np.where(h > 0, self.selected[1][j] - j, 0)

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places in lo..hi where the values are x, or -1: the successor of x in its range, if it is x."""
        out = np.full(len(x), -1, np.int64)
        h = (x >> U(self.bits)).astype(np.int64)
        last = len(self.selected[1]) - 1
        live = np.flatnonzero((h <= last) & (lo < hi))
        h = h[live]
        a, b = np.maximum(self._before(h), lo[live]), np.minimum(self._before(h + 1), hi[live])
        want = x[live] & U((1 << self.bits) - 1)
        # Halve what is left of each bucket.
        while True:
            open_ = a < b
            if not open_.any():
                break
            live, a, b, want = live[open_], a[open_], b[open_], want[open_]
            mid = (a + b) >> 1
            got = self.lows(mid)
            hit = got == want
            out[live[hit]] = mid[hit]
            a = np.where(got < want, mid + 1, a)
            b = np.where(hit, a, np.where(got > want, mid, b))
        return out

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.int64), self.low, self.high]


def quantised(x: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes of x and the value that each stands for: the mean of one of 256 equal shares."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(levels)
    edges = np.quantile(x, np.linspace(0, 1, levels + 1)[1:-1])
    code = np.searchsorted(edges, x, "right").astype(np.uint8)
    n = np.bincount(code, minlength=levels)
    return code, np.bincount(code, x, levels) / np.maximum(n, 1)


# ---- the trie -----------------------------------------------------------------------------------


@dataclass
class Level:
    """The n-grams of one length: those below context p are in pointers[p]..pointers[p + 1]."""

    words: EliasFano
    pointers: EliasFano
    codes: np.ndarray
    values: np.ndarray
    weight_codes: np.ndarray
    weight_values: np.ndarray

    @classmethod
    def of(cls, parent: np.ndarray, word: np.ndarray, n_parents: int, logp: np.ndarray, log_weight: np.ndarray, exact: bool = False) -> Level:
        """n-grams in order of (parent, word); log_weight by n-gram: of it as a context; exact: without 8-bit codes."""
        begins = np.searchsorted(parent, np.arange(n_parents + 1))
        last = np.flatnonzero(np.diff(parent, append=-1)) if len(parent) else np.zeros(0, np.int64)
        step = word[last] + 1
        before = np.cumsum(step) - step
        base = np.repeat(before, np.diff(np.concatenate([[-1], last])))
        code = (lambda x: (np.arange(len(x)), x)) if exact else quantised
        return cls(EliasFano.of(base + word + 1), EliasFano.of(begins), *code(logp), *code(log_weight))

    def find(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of n-grams, or -1; those of one context one after another."""
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        context, n = parent[first], np.diff(np.append(first, len(parent)))
        lo, hi = self.pointers[context].astype(np.int64), self.pointers[context + 1].astype(np.int64)
        base = np.where(lo > 0, self.words[np.maximum(lo - 1, 0)] if self.words.n else U(0), U(0))
        return self.words.find(np.repeat(base, n) + word.astype(U) + U(1), np.repeat(lo, n), np.repeat(hi, n))

    def arrays(self) -> list[np.ndarray]:
        return [*self.words.arrays(), *self.pointers.arrays(), self.codes, self.values, self.weight_codes, self.weight_values]

    @classmethod
    def over(cls, a: list[np.ndarray]) -> Level:
        ef = lambda x: EliasFano(int(x[0][0]), int(x[0][1]), *x[1:])
        return cls(ef(a[:3]), ef(a[3:6]), *a[6:])


@dataclass
class Trie:
    hashes: np.ndarray  # of the words, ascending
    ids: np.ndarray  # of those
    logp: np.ndarray  # by id
    log_weight: np.ndarray  # by id, as a context
    two: Level
    three: Level

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Ids of hashed words, -1 for those that aren't in the trie."""
        if not len(self.hashes):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], -1)

    def score(self, ids: np.ndarray, doc: np.ndarray, two=None, three=None) -> np.ndarray:
        """log10 probability of each token; for words outside the trie without their unigram.

        two, three: nodes of the n-grams that end at given tokens, where the caller has looked them up.
        """
        n, size = len(ids), len(self.logp)
        lp = np.where(ids >= 0, self.logp[np.maximum(ids, 0)], 0.0) if size else np.zeros(n)
        if n < 2 or not size:
            return lp

        def lookup(level: Level, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
            key, where = np.unique(parent * size + word, return_inverse=True)
            return level.find(key // size, key % size)[where]

        at = np.flatnonzero((doc[1:] == doc[:-1]) & (ids[:-1] >= 0)) + 1
        lp[at] += self.log_weight[ids[at - 1]]
        node = np.full(n, -1, np.int64)
        at = at[ids[at] >= 0]
        node[at] = two(at) if two else lookup(self.two, ids[at - 1], ids[at])
        hit = np.flatnonzero(node >= 0)
        lp[hit] = self.two.values[self.two.codes[node[hit]]]
        at = np.flatnonzero((doc[1:] == doc[:-1]) & (node[:-1] >= 0)) + 1
        lp[at] += self.two.weight_values[self.two.weight_codes[node[at - 1]]]
        at = at[ids[at] >= 0]
        found = three(at) if three else lookup(self.three, node[at - 1], ids[at])
        hit = found >= 0
        lp[at[hit]] = self.three.values[self.three.codes[found[hit]]]
        return lp

    def to_bytes(self) -> bytes:
        arrays = [self.hashes, self.ids, self.logp, self.log_weight, *self.two.arrays(), *self.three.arrays()]
        heads, body, at = [], [], 0
        for a in arrays:
            raw = np.ascontiguousarray(a).tobytes()
            heads.append(f"{a.dtype.str},{len(a)},{at}")
            body.append(raw + bytes(-len(raw) % 64))
            at += len(body[-1])
        head = "\n".join(heads).encode()
        head += b" " * (-(len(head) + 8) % 64)
        return len(head).to_bytes(8, "little") + head + b"".join(body)

    @classmethod
    def over(cls, data) -> Trie:
        """A trie over a buffer; nothing is copied."""
        n = int.from_bytes(data[:8], "little")
        arrays = []
        for line in bytes(data[8 : 8 + n]).decode().strip().split("\n"):
            kind, size, at = line.split(",")
            arrays.append(np.frombuffer(data, np.dtype(kind), int(size), 8 + n + int(at)))
        return cls(*arrays[:4], Level.over(arrays[4:14]), Level.over(arrays[14:24]))


_mapped: dict[str, Trie] = {}


def mapped(name: str, raw: bytes) -> Trie:
    """The trie of this worker, mapped from a file that no longer has a name."""
    if name not in _mapped:
        _mapped.clear()
        fd, path = tempfile.mkstemp()
        try:
            os.write(fd, raw)
            _mapped[name] = Trie.over(mmap.mmap(fd, len(raw), access=mmap.ACCESS_READ))
        finally:
            os.close(fd)
            os.unlink(path)
    return _mapped[name]


# ---- counting -----------------------------------------------------------------------------------


def tokens(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words with the end of each text, and their documents."""
    h, doc, _, _ = words(b, lower=True)
    doc = np.concatenate([doc, np.arange(b.n)])
    order = np.argsort(doc, kind="stable")
    return np.concatenate([h, np.full(b.n, END)])[order], doc[order]


def counted(docs: DataFrame, text_col: str, keys) -> DataFrame:
    """(key, n) of what keys(block) lists, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def merged():
            k = np.concatenate([x[0] for x in some])
            n = np.concatenate([x[1] for x in some])
            order = np.argsort(k, kind="stable")
            k, n = k[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            return k[first], np.add.reduceat(n, first) if len(k) else n

        def out(k, n):
            for lo in range(0, len(k), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(k[lo : lo + (1 << 17)].view(np.int64)), pa.array(n[lo : lo + (1 << 17)])], ["key", "n"])

        for batch in batches:
            for b in blocks(batch.column(0), 1 << 21):
                k, n = np.unique(keys(b), return_counts=True)
                some.append((k, n.astype(np.int64)))
                held += len(k)
                if held > 3_000_000:
                    some[:] = [merged()]
                    held = len(some[0][0])
                    if held > 2_000_000:
                        yield from out(*some.pop())
                        held = 0
        if some:
            yield from out(*merged())

    return docs.select(text_col).mapInArrow(tidy(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent(counts_: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of SEEN or more, in order of key; an error if they are more than `most`."""
    kept = counts_.filter(F.col("n") >= SEEN)
    if (n := kept.count()) > most:
        raise ValueError(f"{n} n-grams are too many for a broadcast trie; whole_scores() has no such bound")
    rows = kept.toArrow()
    key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(key)
    return key[order], n[order]


def build(docs: DataFrame, text_col: str = "text") -> tuple[bytes, DataFrame, int, int]:
    """From training texts: the trie, the table (key, n) of unigrams, their sum and number."""
    unigrams = written(counted(docs, text_col, lambda b: tokens(b)[0]), "unigrams")
    total, distinct = (int(x or 0) for x in unigrams.agg(F.sum("n"), F.count("*")).first())
    if distinct > VOCABULARY:
        raise ValueError(f"{distinct} words are too many for a broadcast trie; whole_scores() has no such bound")
    top = unigrams.orderBy(F.desc("n"), "key").toArrow()
    hashes, n1 = top.column("key").to_numpy().view(U), top.column("n").to_numpy()
    size = len(hashes)
    order = np.argsort(hashes)
    sorted_hashes, ids = hashes[order], order.astype(np.int64)
    empty = Level.of(np.zeros(0, np.int64), np.zeros(0, np.int64), size, np.zeros(0), np.zeros(0))
    trie = Trie(sorted_hashes, ids, np.log10((n1 + 1.0) / (total + distinct + 1.0)), np.zeros(size), empty, empty)
    if not size:
        return trie.to_bytes(), unigrams, total, distinct

    def bigram_keys(b: Block) -> np.ndarray:
        h, doc = tokens(b)
        i = Trie.lookup(trie, h)
        at = np.flatnonzero((doc[1:] == doc[:-1]) & (i[:-1] >= 0) & (i[1:] >= 0))
        return i[at] * size + i[at + 1]

    key2, n2 = frequent(written(counted(docs, text_col, bigram_keys), "bigrams"), LEVEL)
    v, w = key2 // size, key2 % size

    def trigram_keys(b: Block) -> np.ndarray:
        h, doc = tokens(b)
        i = Trie.lookup(trie, h)
        at = np.flatnonzero((doc[1:] == doc[:-1]) & (i[:-1] >= 0) & (i[1:] >= 0))
        key = i[at] * size + i[at + 1]
        place = np.minimum(np.searchsorted(key2, key), max(len(key2) - 1, 0))
        node = np.full(len(h), -1, np.int64)
        if len(key2):
            hit = key2[place] == key
            node[at[hit] + 1] = place[hit]
        last = np.flatnonzero((node[1:] >= 0) & (node[:-1] >= 0) & (doc[1:] == doc[:-1])) + 1
        return node[last - 1] * size + i[last]

    key3, n3 = frequent(written(counted(docs, text_col, trigram_keys), "trigrams"), LEVEL)
    p, x = key3 // size, key3 % size

    p1 = (n1 + 1.0) / (total + distinct + 1.0)
    part2 = (n2 - DISCOUNT) / n1[v]
    weight1 = np.clip(1 - np.bincount(v, part2, size), 1e-6, 1)
    p2 = part2 + weight1[v] * p1[w]
    part3 = (n3 - DISCOUNT) / n2[p]
    weight2 = np.clip(1 - np.bincount(p, part3, len(key2)), 1e-6, 1)
    # The probability of a trigram's last word after its second: that bigram was kept too.
    lower = p2[np.searchsorted(key2, w[p] * size + x)] if len(key3) else np.zeros(0)
    p3 = part3 + weight2[p] * lower
    two = Level.of(v, w, size, np.log10(p2), np.log10(weight2))
    three = Level.of(p, x, len(key2), np.log10(p3), np.zeros(len(key3)))
    return Trie(sorted_hashes, ids, np.log10(p1), np.log10(weight1), two, three).to_bytes(), unigrams, total, distinct


SCORES = ("lm_tokens", "lm_known", "lm_base", "lm_score")
PARTS = "lm_tokens long, {own}known long, {own}base double, {own}score double, {own}rare array<struct<key:long,n:int>>"


def score(docs: DataFrame, model: tuple[bytes, DataFrame, int, int], text_col: str = "text") -> DataFrame:
    """docs without the text, with lm_tokens, lm_known, lm_base and lm_score; columns of those names are replaced."""
    docs = docs.drop(*SCORES)
    own = fresh_prefix(docs, "top_")
    raw, unigrams, total, distinct = model
    name = f"{len(raw)}-{hash(raw)}"
    kept = [f for f in docs.schema.fields if f.name != text_col]
    at = docs.columns.index(text_col)
    kept_at = [i for i in range(len(docs.columns)) if i != at]
    schema = T.StructType([*kept, *T.StructType.fromDDL(PARTS.format(own=own)).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = mapped(name, raw)
        for batch in batches:
            for b in blocks(batch.column(at)):
                h, doc = tokens(b)
                ids = trie.lookup(h)
                lp = trie.score(ids, doc)
                known = ids >= 0
                base = np.bincount(doc[known], trie.logp[ids[known]], b.n) if known.any() else np.zeros(b.n)
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((h[rare], doc[rare]))]
                k, d = h[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])) if len(k) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(k))).astype(np.int32)
                bounds = np.searchsorted(d[first], np.arange(b.n + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(k[first].view(np.int64)), pa.array(n)], ["key", "n"])
                cols = [pa.array(np.bincount(doc, minlength=b.n)), pa.array(np.bincount(doc[known], minlength=b.n)), pa.array(base), pa.array(np.bincount(doc, lp, b.n)), pa.ListArray.from_arrays(pa.array(bounds), pairs)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(b.lo, b.n) for i in kept_at], *cols], names)

    mine = lambda c: F.col(own + c)
    parts = written(docs.mapInArrow(tidy(run), schema).withColumn(own + "row", F.monotonically_increasing_id()), "lm-parts")
    rare = parts.select(mine("row").alias("row"), F.explode(own + "rare").alias("t")).select("row", "t.key", F.col("t.n").alias("tf"))
    joined = rare.join(unigrams.withColumnRenamed("n", "c"), "key", "left")
    c = F.coalesce("c", F.lit(0))
    sums = joined.groupBy(F.col("row").alias(own + "of")).agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias(own + "more_known"), F.sum(F.col("tf") * F.log10((c + 1.0) / float(total + distinct + 1))).alias(own + "more_base")
    )
    more = F.coalesce(mine("more_base"), F.lit(0.0))
    return (
        parts.join(sums, mine("row") == mine("of"), "left")
        .withColumn("lm_known", mine("known") + F.coalesce(mine("more_known"), F.lit(0)))
        .withColumn("lm_base", mine("base") + more)
        .withColumn("lm_score", mine("score") + more)
        .drop(*[own + c for c in ("rare", "row", "of", "more_known", "more_base", "known", "base", "score")])
    )


# ---- the whole model, in shards -----------------------------------------------------------------

CHUNK = "chunk long, n_tokens long, words binary, ids binary, sizes binary, train binary"
ASKED = "shard int, chunk long, keys binary, contexts binary, n binary"
#: An answer has a chunk and counts; what contexts lose has the shard it goes to and keys; sums of the level come with each shard.
ANSWERED = "chunk long, shard int, keys binary, n binary, lost binary, total long, n_distinct long"


def planes(x: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed: high ones are mostly zeros."""
    x = np.ascontiguousarray(x)
    raw = x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unplanes(raw: bytes, kind=np.int64) -> np.ndarray:
    got = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(got, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def chunks(docs: DataFrame, text_col: str, train_col: str) -> DataFrame:
    """docs, some megabytes a row: columns without the text as an array of structs, and tokens as places in a list of words."""
    at, train_at = docs.columns.index(text_col), docs.columns.index(train_col)
    kept = [f for f in docs.schema.fields if f.name not in (text_col, train_col)]
    kept_at = [docs.columns.index(f.name) for f in kept]
    names = [f.name for f in kept]
    schema = T.StructType([*T.StructType.fromDDL(CHUNK).fields, T.StructField("rows", T.ArrayType(T.StructType(kept)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def chunk():
            nonlocal number, size
            h = np.concatenate([x[0] for x in held])
            word, ids, n = np.unique(h, return_inverse=True, return_counts=True)
            # Frequent words get small numbers, which compress.
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            word, ids = word[order], rank[ids]
            sizes, train = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            rows = pa.concat_arrays([x[3] for x in held])
            cols = [pa.array([number]), pa.array([len(h)]), *(pa.array([x], pa.binary()) for x in (word.tobytes(), planes(ids.astype(np.int32)), planes(sizes.astype(np.int64)), train.tobytes()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], schema.names)
            number, size = number + 1, 0
            held.clear()

        for batch in batches:
            row = pa.StructArray.from_arrays([batch.column(i) for i in kept_at], names)
            train = batch.column(train_at).fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)
            for b in blocks(batch.column(at)):
                h, doc = tokens(b)
                held.append((h, np.bincount(doc, minlength=b.n), train[b.lo : b.hi], row.slice(b.lo, b.n)))
                size += len(b.data)
                if size >= CHUNK_BYTES:
                    yield from chunk()
        if held:
            yield from chunk()

    return docs.mapInArrow(tidy(run), schema)


class Chunk:
    """The distinct n-grams of a chunk: keys, keys of their contexts, counts in its training texts."""

    def __init__(self, word: bytes, ids: bytes, sizes: bytes, train: bytes):
        self.word, self.ids = np.frombuffer(word, U), unplanes(ids, np.int32).astype(np.int64)
        sizes, self.train = unplanes(sizes), np.frombuffer(train, np.uint8)
        self.n, self.size = len(sizes), len(self.word)
        self.doc = np.repeat(np.arange(self.n), sizes)
        self.trained = self.train[self.doc]

    def pairs(self) -> None:
        at = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        self.pair, where = np.unique(self.ids[at - 1] * self.size + self.ids[at], return_inverse=True)
        self.node = np.full(len(self.ids), -1, np.int64)
        self.node[at] = where
        self.pair_n = np.bincount(where, self.trained[at], len(self.pair)).astype(np.int64)
        self.v, self.w = self.pair // max(self.size, 1), self.pair % max(self.size, 1)
        self.pair_key = mix(self.word[self.v] * GRAM + self.word[self.w])

    def triples(self) -> None:
        at = np.flatnonzero(self.node[:-1] >= 0) + 1
        at = at[self.node[at] >= 0]
        self.triple, where = np.unique(self.node[at - 1] * self.size + self.ids[at], return_inverse=True)
        self.leaf = np.full(len(self.ids), -1, np.int64)
        self.leaf[at] = where
        self.triple_n = np.bincount(where, self.trained[at], len(self.triple)).astype(np.int64)
        self.p, self.x = self.triple // max(self.size, 1), self.triple % max(self.size, 1)

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k == 1:
            return self.word, np.zeros(0, U), np.bincount(self.ids, self.trained, self.size).astype(np.int64)
        self.pairs()
        if k == 2:
            return self.pair_key, self.word[self.v], self.pair_n
        self.triples()
        return mix(self.pair_key[self.p] * GRAM + self.word[self.x]), self.pair_key[self.p], self.triple_n


def each_row(batch: pa.RecordBatch) -> Iterator[tuple]:
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def by_shard(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in order of shard, and where each shard begins."""
    shard = (mix(key) % U(shards)).astype(np.int64)
    # Short integers are sorted by radix.
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def asked(table_: DataFrame, level: int, shards: int, turn: int) -> DataFrame:
    rounds = ROUNDS[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *parts in each_row(batch):
                key, context, n = Chunk(*parts).level(level)
                order, cut = by_shard(key, shards)
                key, n = key[order], n[order].astype(np.uint32)
                context = context[order] if len(context) else context
                some = [(s, a, b) for s, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a and s % rounds == turn]
                for lo in range(0, len(some), 64):
                    of = some[lo : lo + 64]
                    cols = [[s for s, _, _ in of], [number] * len(of), [key[a:b].tobytes() for _, a, b in of], [context[a:b].tobytes() for _, a, b in of], [planes(n[a:b]) for _, a, b in of]]
                    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["shard", "chunk", "keys", "contexts", "n"])

    return table_.select("chunk", "words", "ids", "sizes", "train").mapInArrow(tidy(run), ASKED)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, a place of each, the number of each key in order, and sums."""
    order = np.argsort(key)
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    where = np.empty(len(k), np.int64)
    where[order] = np.cumsum(new) - 1
    return k[first], order[first], where, *(np.add.reduceat(v[order], first) if len(k) else v for v in values)


def answered(asked_: DataFrame, lost: DataFrame | None, level: int, shards: int) -> DataFrame:
    """Counts for those who asked (0 if the n-gram isn't in the model) with twice the mass lost as a context, and what the level takes of its contexts."""
    least = 1 if level == 1 else SEEN
    rows = asked_ if lost is None else asked_.unionByName(lost.select("shard", F.lit(-1).cast("long").alias("chunk"), "keys", F.lit(None).cast("binary").alias("contexts"), F.col("lost").alias("n")))
    names = [f.name for f in T.StructType.fromDDL(ANSWERED).fields]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def answer(shard: int, got: list[tuple]) -> Iterator[pa.RecordBatch]:
        ask, less = [x for x in got if x[0] >= 0], [x for x in got if x[0] < 0]
        key = np.concatenate([np.frombuffer(x[1], U) for x in ask] or [np.zeros(0, U)])
        n = np.concatenate([unplanes(x[3], np.uint32) for x in ask] or [np.zeros(0, np.uint32)]).astype(np.int64)
        one, first, where, total = summed(key, n)
        total = np.where(total >= least, total, 0)
        takes = np.zeros(len(one), np.int64)
        if less and len(one):
            k, _, _, sums = summed(np.concatenate([np.frombuffer(x[1], U) for x in less]), np.concatenate([unplanes(x[3]) for x in less]))
            takes[np.searchsorted(one, k)] = sums
        cols: list[list] = [[] for _ in names]
        at = 0
        for number, keys, _, _ in ask:
            of = where[at : (at := at + len(keys) // 8)]
            for c, x in zip(cols, (number, shard, None, planes(total[of]), planes(takes[of]) if level < 3 else None, None, None), strict=True):
                c.append(x)
        if level > 1:
            kept = np.flatnonzero(total)
            context = np.concatenate([np.frombuffer(x[2], U) for x in ask] or [np.zeros(0, U)])[first[kept]]
            # Twice the count less the discount, a whole number.
            k, _, _, sums = summed(context, (2 * (total[kept] - DISCOUNT)).astype(np.int64))
            order, cut = by_shard(k, shards)
            k, sums = k[order], sums[order]
            for s, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                if b > a:
                    for c, x in zip(cols, (None, s, k[a:b].tobytes(), None, planes(sums[a:b]), None, None), strict=True):
                        c.append(x)
        for c, x in zip(cols, (None, shard, None, None, None, int(total.sum()), int((total > 0).sum())), strict=True):
            c.append(x)
        for lo in range(0, len(cols[0]), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 64], t) for c, t in zip(cols, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got = None, []
        for batch in batches:
            for shard, *row in each_row(batch):
                if shard != now:
                    if got:
                        yield from answer(now, got)
                    now, got = shard, []
                got.append(tuple(row))
        if got:
            yield from answer(now, got)

    return rows.repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(tidy(run), ANSWERED)


def chunk_trie(c: Chunk, counts_: list[np.ndarray], takes: list[np.ndarray], total: int, distinct: int) -> Trie:
    """The trie of the n-grams of a chunk from their counts in all training texts, and twice what those longer by a word take."""
    weight = lambda n, t: np.clip(1 - t / 2 / np.maximum(n, 1), 1e-6, 1)
    n1, n2, n3 = counts_
    p1, weight1 = (n1 + 1.0) / (total + distinct + 1.0), weight(n1, takes[0])
    two = np.flatnonzero(n2)
    place = np.cumsum(n2 > 0) - 1
    v, w, n = c.v[two], c.w[two], n2[two]
    p2, weight2 = (n - DISCOUNT) / n1[v] + weight1[v] * p1[w], weight(n, takes[1][two])
    three = np.flatnonzero(n3)
    p, x, n = place[c.p[three]], c.x[three], n3[three]
    # The bigram of the last two words was seen as often, so it is there.
    lower = p2[place[np.searchsorted(c.pair, w[p] * c.size + x)]]
    p3 = (n - DISCOUNT) / n2[two][p] + weight2[p] * lower
    level2 = Level.of(v, w, c.size, np.log10(p2), np.log10(weight2), exact=True)
    level3 = Level.of(p, x, len(two), np.log10(p3), np.zeros(len(p3)), exact=True)
    # Words are numbered already; the trie needs no hashes to look them up.
    return Trie(np.zeros(0, U), np.zeros(0, np.int64), np.log10(p1), np.log10(weight1), level2, level3)


def in_order(got: list[tuple], keys: np.ndarray, shards: int, field: int) -> np.ndarray:
    """Answers of all shards, in the order of the n-grams of the chunk."""
    out = np.zeros(len(keys), np.int64)
    order, _ = by_shard(keys, shards)
    out[order] = np.concatenate([unplanes(x[field]) for x in got] or [np.zeros(0, np.int64)])
    return out


def whole_scores(docs: DataFrame, train: Column, text_col: str = "text") -> DataFrame:
    """docs without the text, with lm_tokens, lm_known, lm_base, lm_score and lm_train_tokens under the whole model of those where train holds."""
    in_training = fresh(docs, "train")
    docs = docs.withColumn(in_training, train).drop(*SCORES, "lm_train_tokens")
    table_ = written(chunks(docs, text_col, in_training), "lm-chunks")
    shards = max(SHARDS, int(table_.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD_TOKENS)
    answers, lost = {}, None
    for level in (3, 2, 1):
        turns = []
        for turn in range(ROUNDS[level]):
            less = lost and lost.filter(F.col("shard") % ROUNDS[level] == turn)
            turns.append(written(answered(asked(table_, level, shards, turn), less, level, shards), f"lm-answers-{level}"))
        answers[level] = reduce(DataFrame.union, turns)
        lost = answers[level].filter("keys is not null")
    total, distinct = (int(x or 0) for x in answers[1].agg(F.sum("total"), F.sum("n_distinct")).first())

    fields = table_.schema["rows"].dataType.elementType.fields
    schema = T.StructType([*fields, *T.StructType.fromDDL("lm_tokens long, lm_known long, lm_base double, lm_score double, lm_train_tokens long").fields])
    rows = table_.select("chunk", F.lit(0).alias("level"), F.lit(0).alias("shard"), "words", "ids", "sizes", "train", "rows")
    for level, a in answers.items():
        rows = rows.unionByName(a.filter("chunk is not null").select("chunk", F.lit(level).alias("level"), "shard", F.col("n").alias("words"), F.col("lost").alias("ids")), allowMissingColumns=True)

    def scored(c: Chunk, row: pa.StructArray, got: list[tuple]) -> pa.RecordBatch:
        counts_, takes = [], []
        c.pairs()
        c.triples()
        for level, keys in ((1, c.word), (2, c.pair_key), (3, mix(c.pair_key[c.p] * GRAM + c.word[c.x]))):
            of = [x for x in got if x[0] == level]
            counts_.append(in_order(of, keys, shards, 1))
            takes.append(in_order(of, keys, shards, 2) if level < 3 else None)
        trie = chunk_trie(c, counts_, takes, total, distinct)
        # Each n-gram of the chunk is looked up once.
        two = trie.two.find(c.v, c.w)
        three, below = np.full(len(c.p), -1, np.int64), np.flatnonzero(two[c.p] >= 0)
        three[below] = trie.three.find(two[c.p[below]], c.x[below])
        lp = trie.score(c.ids, c.doc, lambda at: two[c.node[at]], lambda at: three[c.leaf[at]])
        add = lambda x: np.bincount(c.doc, x, c.n)
        cols = [np.bincount(c.doc, minlength=c.n), add(counts_[0][c.ids] > 0).astype(np.int64), add(trie.logp[c.ids]), add(lp), np.full(c.n, total)]
        return pa.RecordBatch.from_arrays([*row.flatten(), *map(pa.array, cols)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, got = None, None, []
        for batch in batches:
            packed = pa.RecordBatch.from_arrays(batch.columns[1:7], batch.schema.names[1:7])
            for i, (level, _, word, ids, *rest) in enumerate(each_row(packed)):
                if level == 0:
                    if now is not None:
                        yield scored(now, row, got)
                    now, row, got = Chunk(word, ids, *rest), batch.column(7).slice(i, 1).flatten(), []
                else:
                    got.append((level, word, ids))
        if now is not None:
            yield scored(now, row, got)

    return rows.repartition("chunk").sortWithinPartitions("chunk", "level", "shard").mapInArrow(tidy(run), schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = whole_scores(docs, ~held_out(F.col("doc_id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lm_tokens").alias("n_tokens"), F.col("lm_known").alias("n_known"), F.col("lm_train_tokens").alias("train_tokens"), F.col("lm_base").alias("base_score"), F.col("lm_score").alias("score"))
