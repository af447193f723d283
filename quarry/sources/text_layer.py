"""Pages with a text layer: nested blocks become lines, lines become Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions.text import dehyphenate, strip

FOLIO = r"^\s*\d{1,4}\s*$"
VERSE = r"^\s*\d{1,3}(?:\s*[-–]\s*\d{1,3})?\s*[.:]"


def page_lines(pages: DataFrame) -> DataFrame:
    """(doc, page, pos, text, size, bold) from pages (doc, page, blocks: array<struct<lines: array<struct<spans: array<struct<text, size, bold>>>>>>)."""
    rows = pages.select("doc", "page", F.posexplode("blocks").alias("b", "block")).select("doc", "page", "b", F.posexplode("block.lines").alias("l", "line"))
    spans = F.col("line.spans")
    rows = rows.select(
        "doc", "page", "b", "l", F.array_join(F.transform(spans, lambda s: s["text"]), "").alias("text"), F.array_max(F.transform(spans, lambda s: s["size"])).alias("size"), F.exists(spans, lambda s: s["bold"]).alias("bold"),
    )
    return rows.withColumn("pos", F.row_number().over(W.partitionBy("doc", "page").orderBy("b", "l")) - 1).drop("b", "l")


def body_size(lines: DataFrame, sample: int = 40, default: float = 10.0) -> DataFrame:
    """(doc, body): the most common size of long lines on the first `sample` pages, the smaller of equals."""
    docs = lines.select("doc").distinct()
    mode = lines.filter((F.length("text") > 30) & (F.col("page") < sample)).groupBy("doc", "size").agg(F.count("*").alias("n"))
    best = mode.groupBy("doc").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("body"))
    return docs.join(best, "doc", "left").withColumn("body", F.coalesce("body", F.lit(default)))


def running_heads(lines: DataFrame, sample: int = 60, hits: int = 4) -> DataFrame:
    """(doc, head): short first or last lines of pages that recur."""
    w = W.partitionBy("doc", "page")
    rows = lines.filter((F.col("page") < sample) & (strip(F.col("text")) != ""))
    rows = rows.withColumn("a", F.row_number().over(w.orderBy("pos"))).withColumn("z", F.row_number().over(w.orderBy(F.desc("pos"))))
    ends = rows.filter("a = 1 or z = 1").select("doc", strip(F.col("text")).alias("head")).filter(F.length("head") <= 60)
    return ends.groupBy("doc", "head").agg(F.count("*").alias("n")).filter(F.col("n") >= hits).select("doc", "head")


def page_markdown(lines: DataFrame, verse_least: int = 2) -> DataFrame:
    """(doc, page, markdown, verse): headings by size or weight, wrapped prose joined, pages dense with verses flagged."""
    s = strip(F.col("text"))
    rows = lines.join(body_size(lines), "doc")
    heads = running_heads(lines).select(F.col("doc").alias("_d"), "head")
    rows = rows.withColumn("s", s).join(heads, (F.col("doc") == F.col("_d")) & (F.col("s") == F.col("head")), "left_anti")
    rows = rows.filter((F.col("s") != "") & ~F.col("s").rlike(FOLIO))
    heading = (F.col("size") >= F.col("body") + 1.2) | (F.col("bold") & (F.length("s") < 70))
    mark = F.when(F.col("size") >= F.col("body") + 3, "#").otherwise("##")
    line = F.when(heading, F.concat(F.lit("\n"), mark, F.lit(" "), F.col("s"), F.lit("\n"))).otherwise(F.col("text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("t")))), lambda x: x["t"]), "\n")
    out = rows.groupBy("doc", "page").agg(text.alias("t"), (F.count_if(F.col("s").rlike(VERSE)) >= verse_least).alias("verse"))
    joined = F.regexp_replace(dehyphenate(F.col("t")), r"(?<![\n.!?:;\"')\]])\n(?=[a-zà-ɏ])", " ")
    return out.select("doc", "page", strip(joined).alias("markdown"), "verse")


def converted(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, text, verse_pages, empty_pages): pages (doc, page) lists those that exist."""
    rows = pages.select("doc", "page").join(page_markdown(lines), ["doc", "page"], "left")
    shown = F.when(F.coalesce("markdown", F.lit("")) != "", F.concat(F.lit("<!-- page "), (F.col("page") + 1).cast("string"), F.lit(" -->\n"), F.col("markdown")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(shown.isNotNull(), F.struct("page", shown.alias("t"))))), lambda x: x["t"]), "\n\n")
    return rows.groupBy("doc").agg(
        text.alias("text"), F.array_sort(F.collect_list(F.when(F.col("verse"), F.col("page")))).alias("verse_pages"), F.array_sort(F.collect_list(F.when(shown.isNull(), F.col("page")))).alias("empty_pages")
    )
