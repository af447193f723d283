"""Readers: corpora, chunk files, layouts, dossiers, packs, chapters and binary files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import strip
from ..operators.numbering import numbered

CHUNK = "rowid long, source string, chunk int, trail string, heading string, page_start int, page_end int, text string, context string"
PASSAGE = "struct<id:string,chunk_id:bigint,source:string,trail:string,heading:string,page_start:int,page_end:int,score:double,text:string>"
PACK = f"n int, title string, theme string, scope string, kb struct<hash:string,count:bigint,config:string>, subtopics array<struct<key:string,question:string,status:string,note:string,cut:double,unevidenced:array<string>,n_candidates:int,queries:array<string>,retrieval:struct<reranker:string,floor_mode:string>,passages:array<{PASSAGE}>>>"
DOSSIER = "source string, identity struct<author:string,title:string,year:int,publisher:string,edition:string>, kind string, genre string, coverage struct<period_from:int,period_to:int,geography:array<string>,monuments:array<string>>, stance string, reliability_notes array<string>, summary string, key_claims array<string>, caveats array<string>"
LAYOUT = "page int, image string, raw string, elements array<struct<type:string,bbox:array<double>,text:string>>, markdown string, seconds double"
GOLD = "id string, chapter int, subtopic string, question string, relevant_chunks array<bigint>, reference_facts array<string>, expected_empty boolean, kind string, verified boolean"
DET = r"(?i)<\|det\|>\s*([a-z_]+)\s*(\[[^\]]*\])?\s*<\|/det\|>"
SKIPPED = ("header", "footer", "image", "page_number")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def discover(spark: SparkSession, path: str, recursive: bool = True, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of files; contents aren't read.  exclude is a pattern for names."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if include:
        r = r.option("pathGlobFilter", include)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.filter(~file_name(F.col("path")).rlike(exclude)) if exclude else df


def markdown_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(source, text): a row a file."""
    return spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True).select(file_name(F.col("_metadata.file_path")).alias("source"), F.col("value").alias("text"))


def chunk_file(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records with a row id of their own; where the file has none it follows (source, chunk)."""
    df = spark.read.schema(CHUNK).json(path)
    if not df.filter("rowid is null").limit(1).count():
        return df
    own = numbered(df, ["source", "chunk"], name="_number", start=0)
    return own.withColumn("rowid", F.coalesce("rowid", "_number")).select(*df.columns)


def vectors(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """(rowid, embedding) from Parquet; the number of rows is checked where it is known."""
    df = spark.read.parquet(path)
    if expected is not None and (n := df.count()) != expected:
        raise ValueError(f"{n} vectors for {expected} rows")
    return df


def dossiers(spark: SparkSession, path: str) -> DataFrame:
    """Nested source records; a file that isn't JSON is a row of nulls and left out."""
    df = spark.read.schema(DOSSIER).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    df = df.withColumn("source", F.coalesce("source", F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.json$", "")))
    return df.filter("identity is not null or kind is not null or summary is not null")


def packs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACK).option("multiLine", True).json(path)


def gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD).json(path)


def chapters(spark: SparkSession, path: str) -> DataFrame:
    """(chapter, text) of files chapter-<n>.md."""
    df = spark.read.option("pathGlobFilter", "chapter-*.md").text(path, wholetext=True)
    return df.select(F.regexp_extract("_metadata.file_path", r"chapter-(\d+)[^/]*$", 1).cast("int").alias("chapter"), F.col("value").alias("text"))


def registry(spark: SparkSession, path: str | None, table: str | None, seed: list[tuple]) -> DataFrame:
    """(entity_id, canonical, type, aliases, curated): a JSON file, else a table, else the seed."""
    schema = "entity_id string, canonical string, type string, aliases array<string>, curated boolean"
    if path:
        jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
        if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
            return spark.read.schema(schema).json(path)
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame(seed, schema)


# ---- layouts ------------------------------------------------------------------------------------


def det_spans(raw: Column) -> Column:
    """[(type, bbox, text)] of layout marks; a text runs to the next mark; without marks all is one text."""
    kinds, boxes = F.regexp_extract_all(raw, F.lit(DET), F.lit(1)), F.regexp_extract_all(raw, F.lit(DET), F.lit(2))
    texts = F.slice(F.split(raw, DET), 2, F.greatest(F.size(kinds), F.lit(1)))
    box = lambda b: F.filter(F.transform(F.regexp_extract_all(b, F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1)), lambda x: x.cast("double")), lambda x: x.isNotNull())
    rows = F.transform(F.arrays_zip(kinds.alias("k"), boxes.alias("b"), texts.alias("t")), lambda z: F.struct(F.lower(z["k"]).alias("type"), box(z["b"]).alias("bbox"), strip(z["t"]).alias("text")))
    whole = F.array(F.struct(F.lit("text").alias("type"), F.array().cast("array<double>").alias("bbox"), strip(raw).alias("text")))
    return F.when(F.size(kinds) > 0, rows).otherwise(whole)


def elements_markdown(elements: Column) -> Column:
    """Elements as Markdown: furniture goes, titles become headings, others keep their type in a comment."""
    shown = F.filter(elements, lambda e: ~e["type"].isin(*SKIPPED) & (F.trim(F.coalesce(e["text"], F.lit(""))) != ""))
    line = lambda e: F.when(e["type"] == "title", F.concat(F.lit("## "), strip(e["text"]))).when(e["type"] == "text", strip(e["text"])).otherwise(F.concat(F.lit("<!-- element:"), e["type"], F.lit(" -->\n"), strip(e["text"])))
    return F.array_join(F.transform(shown, line), "\n\n")


def layouts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).json(path)


def layout_markdown(pages: DataFrame, by: str | None = None) -> DataFrame:
    """One text of a document's pages in order, empty ones left out, with page marks."""
    md = F.coalesce(F.nullif(F.trim("markdown"), F.lit("")), elements_markdown(F.coalesce("elements", det_spans(F.coalesce("raw", F.lit(""))))))
    rows = pages.withColumn("_md", F.trim(md)).filter("_md <> ''")
    marked = F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n"), F.col("_md"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", marked.alias("md")))), lambda x: x["md"]), "\n\n").alias("text")
    return rows.groupBy(by).agg(text) if by else rows.agg(text)


def page_text(pages: DataFrame, total: DataFrame, by: str = "source") -> DataFrame:
    """Pages 0..n-1 of each document (source, total) as one text; what is missing or blank is said."""
    want = total.select(by, F.explode(F.expr("sequence(0, total - 1)")).alias("page"))
    body = F.when(F.col("text").isNull(), "[NOT PROCESSED]").when(F.trim("text") == "", "[No machine-readable text detected]").otherwise(F.col("text"))
    rows = want.join(pages.select(by, "page", "text"), [by, "page"], "left").withColumn("body", F.concat(F.lit("<!-- page "), (F.col("page") + 1).cast("string"), F.lit(" -->\n"), body))
    return rows.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "body"))), lambda x: x["body"]), "\n\n").alias("text"))


def page_parts(files: DataFrame, chunk_mb: float = 8, page_cap: int = 100) -> DataFrame:
    """(path, lo, hi) page ranges of files (path, length, pages) of about chunk_mb."""
    per = F.least(F.lit(page_cap), F.greatest(F.lit(1), F.floor(F.lit(chunk_mb * (1 << 20)) / F.greatest(F.lit(1.0), F.col("length") / F.col("pages"))))).cast("int")
    rows = files.withColumn("per", per).withColumn("lo", F.explode(F.expr("sequence(0, pages - 1, per)")))
    return rows.select("path", "lo", F.least(F.col("lo") + F.col("per"), F.col("pages")).alias("hi"))


def split_pages(text: Column) -> Column:
    """[(page, text)] of a text with page marks."""
    numbers = F.regexp_extract_all(text, F.lit(r"<!--\s*page\s+(\d+)[^>]*-->"), F.lit(1))
    bodies = F.slice(F.split(text, r"<!--\s*page\s+\d+[^>]*-->"), 2, F.greatest(F.size(numbers), F.lit(1)))
    return F.transform(F.arrays_zip(numbers.alias("n"), bodies.alias("t")), lambda z: F.struct(z["n"].cast("int").alias("page"), strip(z["t"]).alias("text")))
