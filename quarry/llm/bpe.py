"""BPE encoding and decoding with content-defined chunk reuse.

A document is cut after words where a rolling hash over its last bytes hits a fixed
pattern, so equal passages are cut alike wherever they stand; a chunk has the white space
before its words, so the chunks of a document are its text.  Every worker keeps a bounded
table of recent chunks, and a chunk that documents share is encoded once there, as a whole.

Joins are repaired: at each cut the words on both sides, as many as the longest token of the
tokenizer spans, are encoded together and apart.  Where that differs, the two chunks are
merged, the merged one is encoded anew as a whole, and the cuts next to it are verified again
over twice as many words, until all agree.  What was verified is remembered, in a bounded table
too: the words at a cut, or the characters there if no token of the tokenizer goes on after the
end of a word.

Nulls count as empty texts, which have no tokens.  Very long texts are coded whole, a chunk at a
time.  Repeated rows give equal results.  Other columns are left alone, those named like the
result are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise
from json import dumps, loads

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .blocks import Block, blocks, IS_SPACE, mix, spans, tidy, U
from .common import table

#: A chunk ends after a word where these bits of the rolling hash are 0: about 64 words.
CUT_MASK = 63
#: Bytes that the rolling hash covers.
CUT_BYTES = 16
CACHED_CHUNKS, CACHED_SIDES, CACHED_JOINS = 50_000, 30_000, 30_000
#: Bytes of text whose chunks are encoded at once.
ENCODED_BYTES = 1 << 20
#: Texts that the library encodes at a time: what it gives of a text is some fifty times its size.
BATCH_TEXTS = 1000
#: Rows whose ids and decoded texts are held at once; every worker of an executor holds its own.
CODED_ROWS = 500
#: Longer chunks and joins are not kept in a table.
CACHED_BYTES = 1024
#: The end of a word inside a token; some tokenizers write spaces and line ends as other characters.
ACROSS = re.compile("[^\\s\u2581\u0120\u010a][\\s\u2581\u0120\u010a]")
#: Texts in which only white space and case can be changed by the normalizer below: Latin letters without
#: marks of their own, but for the one whose lower case is two characters.
SIMPLE = re.compile("[\\x01\\t\\n\\r -~\u00a1-\u012f\u0131-\u024f]*")
MARK = b"\x01"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}


class ChunkCoder:
    """Encodes and decodes with a tokenizer of the tokenizers library, given as its JSON."""

    def __init__(self, json: str):
        # A task is one core's work: threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.json, spec = json, loads(json)
        self.joined_by_blanks = spec.get("decoder") is None
        self.plain = self._without_normalizer(spec)
        vocab = (self.plain or self.tokenizer).get_vocab(with_added_tokens=True)
        self.token = np.full(max(vocab.values(), default=-1) + 1, "", object)
        for token, i in vocab.items():
            self.token[i] = token
        spans = [len(ACROSS.findall(t)) for t in vocab]
        #: Words at each side of a cut: as many as a token can reach beyond it.
        self.reach = max([1, *spans])
        #: If no token goes on after a word's end, what happens at a cut depends on the characters there.
        self.by_edge = not any(spans)
        self.chunks = Recent(CACHED_CHUNKS)
        #: Of words at cuts, alone, and of whether they agree.
        self.sides, self.agreed = Recent(CACHED_SIDES), Recent(CACHED_JOINS)

    @cached_property
    def tokenizer(self):
        """The tokenizer as it is given; simple texts don't need it."""
        return self._of(self.json)

    def _of(self, json: str):
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(json)
        t.no_truncation()
        t.no_padding()
        return t

    def _without_normalizer(self, spec: dict):
        """The tokenizer for SIMPLE texts that are normalized before, if its normalizer is the one that is known here."""
        if spec.get("normalizer") != NORMALIZER or any(x["normalized"] for x in spec["added_tokens"]):
            return None
        # Tokens that are found before normalization must not be found after it.
        self.found_before = [x["content"].lower() for x in spec["added_tokens"]]
        return self._of(dumps(spec | {"normalizer": None}))

    def simple(self, texts: str) -> str | None:
        """Texts, with marks between them, as the normalizer leaves them, or None if that takes the normalizer."""
        if self.plain is None or not SIMPLE.fullmatch(texts):
            return None
        low = texts.lower()
        spaced = low.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        while "  " in spaced:
            spaced = spaced.replace("  ", " ")
        return None if any(x in low or x in spaced for x in self.found_before) else spaced

    def direct(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, encoded as a whole, as little-endian unsigned 32-bit integers."""
        whole = self.simple(MARK.join(texts).decode("utf-8", "replace"))
        if whole is not None and len(ready := whole.split(MARK.decode())) == len(texts):
            return self._ids(self.plain, ready)
        ready = [t.decode("utf-8", "replace") for t in texts]
        low = [None if MARK.decode() in t else self.simple(t) for t in ready]
        of_plain = iter(self._ids(self.plain, [x for x in low if x is not None]))
        rest = [t for t, x in zip(ready, low, strict=True) if x is None]
        of_rest = iter(self._ids(self.tokenizer, rest) if rest else [])
        return [next(of_rest if x is None else of_plain) for x in low]

    def _ids(self, tokenizer, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for lo in range(0, len(texts), BATCH_TEXTS):
            ids = [e.ids for e in tokenizer.encode_batch(texts[lo : lo + BATCH_TEXTS], add_special_tokens=False)]
            ends = (4 * np.cumsum([0, *map(len, ids)])).tolist()
            raw = np.fromiter(chain.from_iterable(ids), "<u4", ends[-1] // 4).tobytes()
            out += [raw[i:j] for i, j in pairwise(ends)]
        return out

    def decode(self, ids: bytes) -> str:
        """As the library's decode() with special tokens: without a decoder the tokens, joined by blanks."""
        numbers = np.frombuffer(ids, "<u4")
        if not self.joined_by_blanks:
            return self.tokenizer.decode(numbers.tolist(), skip_special_tokens=False)
        return " ".join(self.token[numbers].tolist())

    def encoded(self, parts: list[bytes], table_: Recent) -> list[bytes]:
        """Ids of texts, each encoded as a whole: from the table, or encoded now."""
        known = [table_.get(p) for p in parts]
        new = list(dict.fromkeys([p for p, ids in zip(parts, known, strict=True) if ids is None]))
        if not new:
            return known
        found = dict(zip(new, self.direct(new), strict=True))
        out = [found[p] if ids is None else ids for p, ids in zip(parts, known, strict=True)]
        for p, ids in found.items():
            if len(p) <= CACHED_BYTES:
                table_.put(p, ids)
        return out

    def joins_agree(self, data: bytes, lo: np.ndarray, mid: np.ndarray, begin: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Are the texts from lo to mid and from mid to hi, encoded one after the other, encoded as when they are one?

        begin: of the word after the white space at mid.
        """
        if not self.by_edge:
            joins = [(data[x:y], data[y:z]) for x, y, z in zip(lo.tolist(), mid.tolist(), hi.tolist(), strict=True)]
            return np.array(self._verified(joins, joins), bool)
        # The bytes at a cut decide; of characters of several bytes all are taken.
        b = np.frombuffer(data, np.uint8)
        left, gap, right = b[mid - 1].astype(np.int64), b[mid].astype(np.int64), b[begin].astype(np.int64)
        short = (left < 128) & (right < 128) & (begin == mid + 1)
        key = np.where(short, left << 16 | gap << 8 | right, (1 << 32) + np.arange(len(mid)))
        _, one, where = np.unique(key, return_index=True, return_inverse=True)
        joins = [(data[x:y], data[y:z]) for x, y, z in zip(lo[one].tolist(), mid[one].tolist(), hi[one].tolist(), strict=True)]
        keys = [(x.decode("utf-8", "replace")[-1:].encode(), y[: k - m] + y[k - m :].decode("utf-8", "replace")[:1].encode()) for (x, y), m, k in zip(joins, mid[one].tolist(), begin[one].tolist(), strict=True)]
        return np.array(self._verified(keys, joins), bool)[where]

    def _verified(self, keys: list[tuple[bytes, bytes]], joins: list[tuple[bytes, bytes]]) -> list[bool]:
        """Do joins agree?  Remembered under the given keys."""
        known = [self.agreed.get(k) for k in keys]
        new = {k: j for k, j, ok in zip(keys, joins, known, strict=True) if ok is None}
        if not new:
            return known
        left, right = (self.encoded([j[i] for j in new.values()], self.sides) for i in (0, 1))
        whole = self.direct([x + y for x, y in new.values()])
        found = {k: x + y == both for k, x, y, both in zip(new, left, right, whole, strict=True)}
        out = [found[k] if ok is None else ok for k, ok in zip(keys, known, strict=True)]
        for k, ok in found.items():
            if len(k[0]) + len(k[1]) <= CACHED_BYTES:
                self.agreed.put(k, ok)
        return out

    def code(self, column: pa.Array) -> Iterator[tuple[bytes, str]]:
        """Ids and decoded text of each text; blocks are cut one by one, and encoded several at once."""
        chunks: list[bytes] = []
        counts: list[int] = []
        size = 0
        for b in blocks(column):
            some, n = self._chunks(b)
            chunks += some
            counts += n
            size += len(b.data)
            if size >= ENCODED_BYTES:
                yield from self._coded(chunks, counts)
                chunks, counts, size = [], [], 0
        yield from self._coded(chunks, counts)

    def cuts(self, b: Block, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places in the block where texts are cut, all of whose joins agree, and their documents."""
        starts, ends, doc = spans(b, ~IS_SPACE[b.data])
        if not len(ends):
            return ends, doc
        # A window of bytes slides over the text; it is looked at where words end, but for those that begin a text.
        windows = np.ndarray((len(data) + 1,), "<u8", bytes(8) + data, strides=(1,))
        rolling = mix(windows[ends].astype(U)) ^ windows[np.maximum(ends - 8, 0)].astype(U)
        inner = np.zeros(len(doc), bool)
        inner[:-1] = doc[1:] == doc[:-1]
        at = np.flatnonzero(inner & (ends - b.offsets[doc] >= CUT_BYTES) & ((mix(rolling) & U(CUT_MASK)) == 0))
        first, last = np.searchsorted(doc, np.arange(b.n)), np.searchsorted(doc, np.arange(b.n), "right") - 1
        reach, unsure = self.reach, np.arange(len(at))
        while len(unsure):
            i = at[unsure]
            lo, mid, hi = starts[np.maximum(i - reach + 1, first[doc[i]])], ends[i], ends[np.minimum(i + reach, last[doc[i]])]
            good = self.joins_agree(data, lo, mid, starts[i + 1], hi)
            bad = unsure[~good]
            if not len(bad):
                break
            # The cuts that stay next to those that go.
            kept = np.ones(len(at), bool)
            kept[bad] = False
            number = np.cumsum(kept) - 1
            beside = np.unique(np.concatenate([number[bad], number[bad] + 1]))
            at = at[kept]
            unsure = beside[(beside >= 0) & (beside < len(at))]
            reach *= 2
        return ends[at], doc[at]

    def _chunks(self, b: Block) -> tuple[list[bytes], list[int]]:
        """The chunks of a block, and how many each document has."""
        data = b.data.tobytes()
        at, doc = self.cuts(b, data)
        n = 1 + np.bincount(doc, minlength=b.n)
        starts = np.empty(len(at) + b.n, np.int64)
        is_first = np.zeros(len(starts), bool)
        is_first[np.cumsum(n) - n] = True
        starts[is_first], starts[~is_first] = b.offsets[:-1], at
        return [data[s:e] for s, e in pairwise([*starts.tolist(), int(b.offsets[-1])])], n.tolist()

    def _coded(self, chunks: list[bytes], counts: list[int]) -> Iterator[tuple[bytes, str]]:
        ids, at = self.encoded(chunks, self.chunks), 0
        for n in counts:
            raw = b"".join(ids[at : at + n])
            at += n
            yield raw, self.decode(raw)


class Recent:
    """A table of at most so many items; what has not been asked for since half as many came goes."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if 2 * len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


_coders: dict[int, ChunkCoder] = {}


def worker_coder(json: str) -> ChunkCoder:
    """The coder of this Python worker: Spark reuses workers, so tables outlive tasks."""
    key = hash(json)
    if key not in _coders:
        _coders.clear()
        _coders[key] = ChunkCoder(json)
    return _coders[key]


def coded_batches(batches: Iterator[pa.RecordBatch], coder: ChunkCoder, at: int) -> Iterator[pa.RecordBatch]:
    """Batches with token_ids and decoded of their column number `at`."""
    for batch in batches:
        # Slices bound what is held at once where a session's batches are large.
        for lo in range(0, batch.num_rows, CODED_ROWS):
            part = batch.slice(lo, CODED_ROWS)
            coded = list(coder.code(part.column(at)))
            cols = [*part.columns, pa.array([c[0] for c in coded], pa.binary()), pa.array([c[1] for c in coded], pa.string())]
            del coded
            yield pa.RecordBatch.from_arrays(cols, [*part.schema.names, "token_ids", "decoded"])


def encode(docs: DataFrame, tokenizer_json: str, text_col: str = "text") -> DataFrame:
    """docs with token_ids (little-endian unsigned 32-bit) and decoded; columns of those names are replaced."""
    docs = docs.drop("token_ids", "decoded")
    schema = T.StructType([*docs.schema.fields, T.StructField("token_ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return coded_batches(batches, worker_coder(tokenizer_json), at)

    return docs.mapInArrow(tidy(run), schema)


def decode(coded: DataFrame, tokenizer_json: str, ids_col: str = "token_ids", to: str = "decoded") -> DataFrame:
    """coded with the texts that token ids stand for."""
    schema = T.StructType([*[f for f in coded.schema.fields if f.name != to], T.StructField(to, T.StringType())])
    at = coded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        for batch in batches:
            texts = [tokenizer.decode(np.frombuffer(x or b"", "<u4").tolist(), skip_special_tokens=False) for x in batch.column(at).to_pylist()]
            cols = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != to]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], schema.names)

    return coded.mapInArrow(tidy(run), schema)


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The JSON of an installed public tokenizer; it is read on the driver and goes to executors with the code."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizer())
    return coded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
