"""ISO media containers: payloads stored as samples, features from the boxes alone.

``store`` puts a payload into a one-track file (ftyp, mdat, moov) as fixed-size samples of
8-bit audio; ``probe`` walks the nested boxes and decodes the sample tables (stsd, mdhd,
stts, stsz, stsc, stco or co64, stss) into codec, duration and keyframe byte ranges; it
never looks into mdat.  ``payload`` then reads the samples at the places the tables name.

Nulls count as empty texts.  Equal payloads give equal files: no time of creation is set, so repeated
rows have equal values.  A very long text is one file, with 64-bit places if it needs them.  An empty
table gives an empty result.  Extra columns are kept; those named like the result are replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .blocks import tidy
from .common import table, written

SAMPLE = 576
#: Samples of a chunk, and from one keyframe to the next.
CHUNK_SAMPLES, KEY_EVERY = 8, 16
RATE = 48_000
PAD = b"\xff"
# Fixed values of the format: boxes that hold boxes, and the codec of unsigned 8-bit samples.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"udta", b"mvex", b"moof", b"traf"}
CODEC = b"raw "
MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def padded(data: bytes, unit: int = SAMPLE) -> bytes:
    """data with bytes 255 up to a positive multiple of unit."""
    return data + PAD * (-len(data) % unit if data else unit)


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def store(data: bytes) -> bytes:
    """A file whose samples, in order, are data (a positive multiple of SAMPLE)."""
    n = len(data) // SAMPLE
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2")
    mdat = box(b"mdat", data)
    start = len(ftyp) + len(mdat) - len(data)
    chunks = -(-n // CHUNK_SAMPLES)
    offsets = [start + i * CHUNK_SAMPLES * SAMPLE for i in range(chunks)]
    rest = n - (chunks - 1) * CHUNK_SAMPLES
    runs = [(1, CHUNK_SAMPLES)] if rest == CHUNK_SAMPLES else [(1, CHUNK_SAMPLES), (chunks, rest)] if chunks > 1 else [(1, rest)]
    wide = start + len(data) >= 1 << 32
    keys = range(1, n + 1, KEY_EVERY)
    entry = box(CODEC, bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
    stbl = box(
        b"stbl",
        full(b"stsd", struct.pack(">I", 1), entry),
        full(b"stts", struct.pack(">III", 1, n, SAMPLE)),
        full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
        full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", a, b, 1) for a, b in runs]),
        full(b"stsz", struct.pack(">II", SAMPLE, n)),
        full(b"co64" if wide else b"stco", struct.pack(f">I{chunks}{'Q' if wide else 'I'}", chunks, *offsets)),
    )
    ticks = n * SAMPLE
    minf = box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), stbl)
    mdhd = full(b"mdhd", struct.pack(">QQIQHH", 0, 0, RATE, ticks, 0x55C4, 0), version=1)
    hdlr = full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0")
    tkhd = full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, ticks), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), MATRIX, bytes(8), version=1, flags=7)
    mvhd = full(b"mvhd", struct.pack(">QQIQIH", 0, 0, RATE, ticks, 0x10000, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2), version=1)
    return ftyp + mdat + box(b"moov", mvhd, box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, minf)))


def walk(data: memoryview, lo: int = 0, hi: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, start, end) of the body of every box, outer boxes first.  Sizes 0 (to the end) and 1 (64 bits) are read."""
    hi = len(data) if hi is None else hi
    while lo + 8 <= hi:
        size, kind = struct.unpack_from(">I4s", data, lo)
        head = 8
        if size == 1:
            if lo + 16 > hi:
                raise ValueError("a box whose size is cut off")
            size, head = struct.unpack_from(">Q", data, lo + 8)[0], 16
        elif size == 0:
            size = hi - lo
        if size < head or lo + size > hi:
            raise ValueError(f"box {kind!r} doesn't fit into what holds it")
        here = (*path, kind)
        yield here, lo + head, lo + size
        if kind in CONTAINERS:
            yield from walk(data, lo + head, lo + size, here)
        lo += size
    if lo != hi:
        raise ValueError("bytes after the last box")


def tracks(data: bytes) -> list[dict]:
    """codec, timescale, duration (ticks), samples (offset, size) and keyframes (numbers from 0) of each track."""
    view, out = memoryview(data), []
    u32 = lambda at, n=1: struct.unpack_from(f">{n}I", view, at)
    for path, lo, _ in walk(view):
        kind = path[-1]
        if kind == b"trak":
            out.append({"keys": None})
            continue
        if len(path) < 3 or path[:2] != (b"moov", b"trak"):
            continue
        t = out[-1]
        if kind == b"mdhd":
            t["timescale"], t["duration"] = struct.unpack_from(">IQ", view, lo + 20) if view[lo] == 1 else u32(lo + 12, 2)
        elif kind == b"stsd":
            t["codec"] = bytes(view[lo + 12 : lo + 16]).decode("latin-1").strip()
        elif kind == b"stts":
            t["deltas"] = [u32(lo + 8 + 8 * i, 2) for i in range(u32(lo + 4)[0])]
        elif kind == b"stss":
            t["keys"] = [k - 1 for k in u32(lo + 8, u32(lo + 4)[0])]
        elif kind == b"stsc":
            t["runs"] = [u32(lo + 8 + 12 * i, 3) for i in range(u32(lo + 4)[0])]
        elif kind == b"stsz":
            size, n = u32(lo + 4, 2)
            t["sizes"] = [size] * n if size else list(u32(lo + 12, n))
        elif kind in (b"stco", b"co64"):
            n = u32(lo + 4)[0]
            t["chunks"] = list(struct.unpack_from(f">{n}{'Q' if kind == b'co64' else 'I'}", view, lo + 8))
    for t in out:
        t["samples"] = _samples(t)
        if t["keys"] is None:
            t["keys"] = list(range(len(t["samples"])))
    return out


def _samples(t: dict) -> list[tuple[int, int]]:
    out, sizes, runs, at = [], t.get("sizes", []), t.get("runs", []), 0
    for i, (first, per_chunk, _) in enumerate(runs):
        stop = runs[i + 1][0] if i + 1 < len(runs) else len(t["chunks"]) + 1
        for chunk in range(first, stop):
            place = t["chunks"][chunk - 1]
            for size in sizes[at : at + per_chunk]:
                out.append((place, size))
                place += size
            at += per_chunk
    if len(out) != len(sizes):
        raise ValueError("sample tables disagree")
    return out


def payload(data: bytes, t: dict) -> bytes:
    return b"".join([data[a : a + n] for a, n in t["samples"]])


def feature(t: dict) -> str:
    """codec, duration in ticks at a scale, samples, and a digest of the keyframe byte ranges with the first of them."""
    ranges = [(t["samples"][k][0], t["samples"][k][0] + t["samples"][k][1]) for k in t["keys"]]
    digest = hashlib.md5(",".join(f"{a}-{b}" for a, b in ranges).encode()).hexdigest()[:16]
    first = f"{ranges[0][0]}-{ranges[0][1]}" if ranges else ""
    return f"{t['codec']};{t['duration']}/{t['timescale']};samples={len(t['samples'])};keys={len(ranges)};first={first};ranges={digest}"


def stored(docs: DataFrame, text_col: str = "text", to: str = "media") -> DataFrame:
    """docs with n_bytes and a media column in place of the text; columns of those names are replaced."""
    docs = docs.drop(to, "n_bytes")
    at = docs.columns.index(text_col)
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != text_col], T.StructField("n_bytes", T.LongType()), T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                raw = [(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in part.column(at).cast(pa.binary())]
                cols = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([len(x) for x in raw], pa.int64()), pa.array([store(padded(x)) for x in raw], pa.binary())], schema.names)

    return docs.mapInArrow(tidy(run), schema)


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, codec string, duration_seconds double, keyframes array<struct<start:long,end:long>>, feature string"


def features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with the columns of FEATURES in place of the stored bytes."""
    at = media.columns.index(media_col)
    new = T.StructType.fromDDL(FEATURES)
    kept = [f for f in media.schema.fields if f.name != media_col and f.name not in new.names]
    schema = T.StructType([*kept, *new.fields])
    kept_at = [media.columns.index(f.name) for f in kept]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]

    def one(x: bytes) -> tuple:
        t = tracks(x)[0]
        data = payload(x, t)
        keys = [{"start": t["samples"][k][0], "end": t["samples"][k][0] + t["samples"][k][1]} for k in t["keys"]]
        return len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(x), hashlib.sha256(x).hexdigest(), t["codec"], t["duration"] / t["timescale"], keys, feature(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = [one(x.as_buffer().to_pybytes()) for x in part.column(at)]
                cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept_at], *cols], schema.names)

    return media.mapInArrow(tidy(run), schema)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = written(stored(table(spark, sf_dir, "documents").select("doc_id", "text")), "media")
    ranges = F.array_join(F.transform("keyframes", lambda k: F.concat_ws("-", k["start"].cast("string"), k["end"].cast("string"))), ",")
    return features(media).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration_seconds", ranges.alias("keyframes"),
    )
