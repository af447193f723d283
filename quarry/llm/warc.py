"""WARC archives with revisit records.

Headers (id, length, payload digest) are shuffled, payloads are not: of equal payloads
of at least ``REVISIT_FROM`` bytes one record with the largest id is the response and the
others become revisits that refer to it by its record id.  Records get fresh headers, a
record id of their own and a gzip member each; a task packs them into archives of about
``ARCHIVE_BYTES``, so neither a file nor what is read of it at once grows with the input.
Spark's text writer stores one archive a file under its commit protocol, in any file system
that Spark writes to.  It wants a separator after each row, which is a gzip member without
content here, so a file is gzip from end to end (its name ends in .txt, which the writer sets).
Archives are read back as files and parsed by Content-Length: payloads may hold anything.

A payload is the UTF-8 of the html (null: empty).  A null url is left out of the header, and a
null id too: such a row revisits the largest id with its payload, and if no row of that payload
has an id they are all responses.  Where rows repeat the largest id of a payload, one of them is
the response and the others revisit it.  Other columns are not stored, whatever their names.  An
empty table gives an archive without records.  Ids are numbers, or text that is one: other text ends the job with a cast error.
Payloads are shuffled by digest where more than BROADCAST_ROWS groups of equal ones exist.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .blocks import tidy
from .common import drop_path, drop_written, new_path, small_side, table, written

REVISIT_FROM = 1000
#: Compressed bytes after which an archive ends; a larger record is an archive of its own.
ARCHIVE_BYTES = 32 << 20
CRLF = "\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
#: A gzip member without content.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def heads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, n, digest, payload) of each page."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))


def resolved(headers: DataFrame) -> DataFrame:
    """(digest, n, refers_to, rows) of payloads that more than one record has: the largest id, and how many have it."""
    by_id = headers.filter(F.col("n") >= REVISIT_FROM).groupBy("digest", "n", "id").agg(F.count("*").alias("rows"))
    groups = by_id.groupBy("digest", "n").agg(F.max("id").alias("refers_to"), F.max_by("rows", "id").alias("rows"), F.sum("rows").alias("copies"))
    return groups.filter("copies > 1 and refers_to is not null").drop("copies")


def _header(pairs) -> Column:
    """Lines of name and value; pairs whose value is null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in pairs]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(END))


def _packed(rows: DataFrame) -> DataFrame:
    """Archives, as text that isn't text, of (header, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def archive():
            nonlocal size
            blob = b"".join(held)
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["value"])

        for batch in batches:
            for header, payload in zip(batch.column(0), batch.column(1), strict=True):
                z = zlib.compressobj(wbits=31)
                member = z.compress(header.as_buffer()) + z.compress(payload.as_buffer()) + z.compress(END.encode()) + z.flush()
                held.append(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield archive()
        if held:
            yield archive()

    return rows.mapInArrow(tidy(run), "value binary").select(F.col("value").cast("string").alias("value"))


def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> tuple[DataFrame, list[DataFrame]]:
    """(id, url, payload, n, digest, refers_to, response_of) of all records to write, and the tables that were written for them."""
    rows = heads(pages, id_col, url_col, payload_col)
    # Written, so that the number of a row stays the same.
    headers = written(rows.filter(F.col("n") >= REVISIT_FROM).drop("payload").withColumn("row", F.monotonically_increasing_id()), "warc-heads")
    groups = small_side(resolved(headers), "warc-groups")
    joined = rows.join(groups, ["digest", "n"], "left")
    largest = F.coalesce(F.col("id") == F.col("refers_to"), F.lit(False))
    response = F.col("refers_to").isNull() | largest
    columns = lambda df: df.select("id", "url", "payload", "n", "digest", "refers_to", "response_of")
    as_revisit = {"payload": F.lit(""), "response_of": F.lit(None).cast("string")}
    digest_of = F.when(largest, F.col("digest"))
    out = joined.withColumn("response_of", digest_of).withColumn("payload", F.when(response, F.col("payload")).otherwise(F.lit("")))
    out = out.withColumn("refers_to", F.when(~response, F.col("refers_to")))
    if not groups.filter("rows > 1").limit(1).count():
        return columns(out), [headers, groups]
    # The largest id of a payload stands in several rows: their headers tell which is the response, whose
    # payload is that of any of them.
    repeated = largest & (F.col("rows") > 1)
    out = joined.select("*", repeated.alias("again")).filter("not again").drop("again")
    out = out.withColumn("response_of", digest_of).withColumn("payload", F.when(response, F.col("payload")).otherwise(F.lit(""))).withColumn("refers_to", F.when(~response, F.col("refers_to")))
    again = headers.join(groups, ["digest", "n"]).filter(repeated)
    chosen = again.groupBy("digest", "n", "id").agg(F.min("row").alias("row"), F.min_by("url", "row").alias("url"))
    others = again.join(chosen.select("digest", "n", F.col("row").alias("first")), ["digest", "n"]).filter("row != first").withColumns(as_revisit)
    payloads = joined.filter(repeated).groupBy("digest", "n").agg(F.first("payload").alias("payload"))
    first = chosen.join(payloads, ["digest", "n"]).withColumn("response_of", F.col("digest")).withColumn("refers_to", F.lit(None).cast("long"))
    return columns(out).union(columns(others)).union(columns(first)), [headers, groups]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    rows, scratch = _records(pages, id_col, url_col, payload_col)
    revisit = F.col("refers_to").isNotNull()
    # The record that others refer to has an id that follows from its page and payload; all others have random ones.
    named = lambda page, digest: F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(":"), digest, F.lit(">"))
    one_line = F.regexp_replace("url", r"[\r\n]+", " ")
    header = _header(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", F.coalesce(named(F.col("id"), F.col("response_of")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Target-URI", one_line),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("WARC-Refers-To", named(F.col("refers_to"), F.col("digest"))),
            ("Page-ID", F.col("id").cast("string")),
            ("Content-Type", F.lit("text/html; charset=utf-8")),
            ("Content-Length", F.when(revisit, 0).otherwise(F.col("n")).cast("string")),
        ]
    )
    archives = _packed(rows.select(header.alias("header"), "payload"))
    separator = EMPTY_MEMBER.decode("latin-1")
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", 1).text(path)
    for df in scratch:
        drop_written(df)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payloads of a WARC stream that comes in pieces."""
    buffer = bytearray()
    ended = False

    def fill(n: int) -> None:
        nonlocal ended
        while len(buffer) < n and not ended:
            piece = next(chunks, None)
            if piece is None:
                ended = True
            else:
                buffer.extend(piece)

    while True:
        at, seen = -1, 0
        while at < 0 and not (ended and seen == len(buffer)):
            seen = len(buffer)
            at = buffer.find(b"\r\n\r\n", 0)
            if at < 0:
                fill(seen + 1)
        if at < 0:
            if buffer.strip():
                raise ValueError("a WARC header without an end")
            return
        lines = bytes(buffer[:at]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = dict(x.split(": ", 1) for x in lines[1:])
        stop = at + 4 + int(header["Content-Length"])
        fill(stop + 4)
        payload = bytes(buffer[at + 4 : stop])
        if len(buffer) < stop + 4 or buffer[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record without its end")
        del buffer[: stop + 4]
        yield header, payload


def gunzipped(data: bytes, piece: int = 1 << 14) -> Iterator[bytes]:
    """Every member of a gzip file, from pieces of input of that size; each expands a thousandfold at most."""
    view, at = memoryview(data), 0
    while at < len(view):
        d = zlib.decompressobj(31)
        while not d.eof and at < len(view):
            part = view[at : at + piece]
            at += len(part)
            if out := d.decompress(part):
                yield out
        if not d.eof:
            raise ValueError("a gzip file without its end")
        at -= len(d.unused_data)


FIELDS = {
    "record_id": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.string(), "url": pa.string(), "header_digest": pa.string(), "stored_bytes": pa.int64(), "stored_digest": pa.string(),
}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: ids of it and of the record it refers to, page_id, type, url, length and digest as stored, and those of the payload read."""

    def row(h: dict[str, str], payload: bytes) -> tuple:
        page = h.get("Page-ID")
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        return h["WARC-Record-ID"], int(page) if page else None, h["WARC-Type"], h.get("WARC-Refers-To"), h.get("WARC-Target-URI"), digest, len(payload), hashlib.sha1(payload).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for h, payload in records(gunzipped(content.as_buffer())):
                    rows.append(row(h, payload))
                    if len(rows) == 10_000:
                        yield as_batch(rows)
                        rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), FIELDS.values(), strict=True)], list(FIELDS))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(tidy(run), ", ".join(f"{name} {'long' if t == pa.int64() else 'string'}" for name, t in FIELDS.items()))


def followed(archive: DataFrame) -> DataFrame:
    """archive with payload_bytes and payload_digest of the full payload: a revisit's are those of the record it refers to."""
    revisit = archive.filter("record_type = 'revisit'")
    whole = archive.filter("record_type = 'response'").withColumn("payload_bytes", F.col("stored_bytes")).withColumn("payload_digest", F.col("stored_digest"))
    target = whole.filter("record_id like '<urn:page:%'").select(F.col("record_id").alias("target"), "payload_bytes", "payload_digest")
    return whole.unionByName(revisit.join(target, F.col("refers_to") == F.col("target"), "left").drop("target"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    archive = written(read_archives(spark, path), "warc-records")
    drop_path(spark, path)
    refers_to = F.regexp_extract("refers_to", "^<urn:page:(-?[0-9]+):", 1)
    return followed(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", F.when(F.col("refers_to").isNotNull(), refers_to.cast("long")).alias("refers_to"))


OP4_SQL = """
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND last_id IS NOT NULL AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND nth > 1 THEN last_id END AS refers_to
FROM (SELECT page_id, n, digest, max(page_id) OVER (PARTITION BY digest, n) AS last_id, row_number() OVER (PARTITION BY digest, n ORDER BY page_id DESC NULLS LAST) AS nth
      FROM (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages))
"""
