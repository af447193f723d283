"""Pages as images and what reads them: clients are given, for none is installed here.

An OcrClient is made on executors by a factory.  Every file gives rows with a status; a failed one never fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .. import scratch
from ..operators.models import RateLimiter, called
from .snapshots import Store

# Media types by ending.
IMAGE_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp", "gif": "image/gif", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff", "avif": "image/avif"}


class OcrClient(Protocol):
    def read_image(self, data_url: str) -> list[str]:
        """The Markdown of each page of an image."""

    def upload(self, name: str, content: bytes) -> str: ...

    def read_document(self, handle: str) -> list[str]:
        """The Markdown of each page of what was uploaded."""

    def delete(self, handle: str) -> None: ...

    def read_layout(self, data_url: str) -> str:
        """The raw marks and text of one page."""


Client = Callable[[], OcrClient]


def data_url(path: Column, content: Column) -> Column:
    """A file as a data URL; endings that aren't known count as PNG."""
    kinds = F.create_map(*[F.lit(x) for kv in IMAGE_TYPES.items() for x in kv])
    kind = F.coalesce(F.try_element_at(kinds, F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))), F.lit("image/png"))
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), F.base64(content))


def _read(rows: DataFrame, client: Client, one: Callable[[OcrClient, pd.Series], list[str]], rate: float, attempts: int) -> DataFrame:
    """(path, page, text, status) of files; one row with a null page where it failed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ocr, limiter = client(), RateLimiter(rate, max(rate, 4.0))
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                try:
                    pages = called(lambda: one(ocr, row), limiter, attempts)  # noqa: B023
                    out += [(row["path"], i, t or "", "ok") for i, t in enumerate(pages)]
                except Exception as e:
                    out.append((row["path"], None, None, f"error:{type(e).__name__}"))
            yield pd.DataFrame(out, columns=["path", "page", "text", "status"]).astype({"page": "Int32"})

    return rows.mapInPandas(run, "path string, page int, text string, status string")


def read_images(files: DataFrame, client: Client, rate: float = 1e9, attempts: int = 4) -> DataFrame:
    """Pages of image files (path, content)."""
    return _read(files.select("path", data_url(F.col("path"), F.col("content")).alias("url")), client, lambda ocr, row: ocr.read_image(row["url"]), rate, attempts)


def read_documents(files: DataFrame, client: Client, rate: float = 1e9, attempts: int = 4) -> DataFrame:
    """Pages of documents (path, content), uploaded for the time of reading; what was uploaded is always deleted."""

    def one(ocr: OcrClient, row: pd.Series) -> list[str]:
        handle = ocr.upload(row["path"].rsplit("/", 1)[-1], row["content"])
        try:
            return ocr.read_document(handle)
        finally:
            ocr.delete(handle)

    return _read(files.select("path", "content"), client, one, rate, attempts)


def read_layouts(images: DataFrame, client: Client, done: DataFrame | None = None, rate: float = 1e9) -> DataFrame:
    """(source, page, raw) of page images (source, page, path, content); pages that are done are not read again."""
    rows = images if done is None else images.join(done.select("source", "page"), ["source", "page"], "left_anti")
    keyed = rows.select(F.concat_ws("\x00", "source", F.col("page").cast("string")).alias("path"), data_url(F.col("path"), F.col("content")).alias("url"))
    got = _read(keyed, client, lambda ocr, row: [ocr.read_layout(row["url"])], rate, 4).filter("status = 'ok'")
    parts = F.split("path", "\x00")
    return got.select(parts[0].alias("source"), parts[1].cast("int").alias("page"), F.col("text").alias("raw"))


def resumed(rows: DataFrame, keys: list[str], compute: Callable[[DataFrame], DataFrame], path: str, rows_a_task: int = 64) -> DataFrame:
    """compute(rows), kept under path as tasks end: a run that was stopped goes on where it was.

    Rows are dealt into tasks of about rows_a_task.  What a task has computed is committed to path when it ends, not when the job
    does, and rows whose keys are there are never computed again, so after a failure only tasks that hadn't ended are lost.  A task that is
    run twice leaves rows twice; the first of a key is returned.  Rows with a null key are computed each time.
    """
    spark = rows.sparkSession
    store = Store(spark, path)
    have = any(n.startswith("part-") for n, _ in store.names(""))
    schema = compute(rows.limit(0)).schema
    left = rows.join(spark.read.schema(schema).parquet(path).select(*keys).distinct(), keys, "left_anti") if have else rows
    left = scratch.written(left, "left")
    if n := left.count():
        # The second algorithm moves a task's files into place when the task commits.
        out = compute(left.repartition(-(-n // rows_a_task)))
        out.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    found = spark.read.schema(schema).parquet(path) if have or n else spark.createDataFrame([], schema)
    return found.dropDuplicates(keys)


def layouts_resumed(images: DataFrame, client: Client, path: str, rate: float = 1e9, pages_a_task: int = 64) -> DataFrame:
    """read_layouts() whose pages are kept under path as they are read; the next run asks for the others alone."""
    return resumed(images, ["source", "page"], lambda rows: read_layouts(rows, client, rate=rate), path, pages_a_task)


def opened(content: bytes, password: str | None = None):
    """A reader of a PDF, decrypted; ValueError with a wrong password or none.  Takes pypdf."""
    import io

    from pypdf import PdfReader

    reader = PdfReader(io.BytesIO(content))
    if reader.is_encrypted and not reader.decrypt(password or ""):
        raise ValueError("encrypted PDF: wrong password or none")
    return reader


def page_images(files: DataFrame, dpi: int = 200, first: int | None = None, last: int | None = None, render: Callable[[bytes, int, int, int | None], Iterator[tuple[int, bytes]]] | None = None) -> DataFrame:
    """(source, page, path, content): pages first to last of PDF files (path, content) as PNG images.

    render(content, dpi, first, last) gives (page, image); without one PyMuPDF is taken, which isn't part of this package.
    """

    def with_mupdf(content: bytes, dpi: int, first: int, last: int | None) -> Iterator[tuple[int, bytes]]:
        import fitz

        doc = fitz.open(stream=content, filetype="pdf")
        for i in range(first - 1, min(last or doc.page_count, doc.page_count)):
            yield i + 1, doc.load_page(i).get_pixmap(dpi=dpi).tobytes("png")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                name = path.rsplit("/", 1)[-1]
                stem = name.rsplit(".", 1)[0]
                rows = [(name, n, f"{stem}_p{n:04d}.png", image) for n, image in (render or with_mupdf)(content, dpi, first or 1, last)]
                yield pd.DataFrame(rows, columns=["source", "page", "path", "content"])

    return files.select("path", "content").mapInPandas(run, "source string, page int, path string, content binary")
