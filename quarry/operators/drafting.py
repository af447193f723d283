"""What goes into and comes out of drafting: queries, embedding texts, plans, section edits, legacy page work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import text as tx
from . import numbering

# Patterns of captions and years.
CAPTION = r"(?i)\b((?:fig|figure|plate|pl|map|table)\.?\s*[0-9IVXivx]+[^\n.;]{0,70})"
YEAR = r"\b(?:1[0-9]{3}|[89][0-9]{2})\b"


# ---- queries ------------------------------------------------------------------------------------


def deterministic_queries(question: Column, anchor: Column) -> Column:
    return F.when(F.coalesce(anchor, F.lit("")) == "", F.array(question)).otherwise(F.array(question, F.concat_ws(" — ", question, anchor)))


def query_union(first: Column, more: Column) -> Column:
    """Both lists in order; of queries that differ in case alone the first stays."""
    both = F.filter(F.concat(first, F.coalesce(more, F.array().cast("array<string>"))), lambda q: F.trim(q) != "")
    return tx.let(both, lambda a: tx.let(F.transform(a, lambda q: F.lower(F.trim(q))), lambda low: F.filter(a, lambda q, i: F.array_position(low, F.lower(F.trim(q))) == i + 1)))


def stale_entries(subs: DataFrame, cache: DataFrame) -> DataFrame:
    """Sub-topics (key, question) whose cached fingerprint is missing or of another question."""
    fp = F.substring(F.sha1(F.col("question").cast("binary")), 1, 16)
    rows = subs.withColumn("fingerprint", fp).join(cache.select("key", F.col("fingerprint").alias("_f")), "key", "left")
    return rows.filter(~F.col("fingerprint").eqNullSafe(F.col("_f"))).drop("_f")


# ---- embedding texts ----------------------------------------------------------------------------


def embed_text(source: Column, trail: Column, context: Column, body: Column, least_latin: int = 200, share: float = 0.9) -> Column:
    """[source] trail, context and body; of a text in two scripts only the Latin lines, without code fences."""
    body = tx.empty_if_null(body)
    latin = F.filter(F.split(body, "\n"), lambda x: (tx.strip(x) != "") & ~tx.has_devanagari(x))
    n = F.aggregate(latin, F.lit(0), lambda a, x: a + F.length(x))
    shown = F.when((n >= least_latin) & (n < F.length(body) * share), F.array_join(F.filter(latin, lambda x: ~F.ltrim(x).startswith("```")), "\n")).otherwise(body)
    head = F.trim(F.concat(F.lit("["), source, F.lit("] "), tx.empty_if_null(trail)))
    return tx.strip(F.concat_ws("\n", head, F.when(tx.empty_if_null(context) != "", context), shown))


def context_sentence(title: Column, genre: Column, trail: Column, page_from: Column, page_to: Column) -> Column:
    """A preamble from metadata alone."""
    pages = F.when(page_from.isNull(), None).when(page_to.isNull() | (page_to == page_from), F.concat(F.lit("Page "), page_from.cast("string"), F.lit("."))).otherwise(
        F.concat(F.lit("Pages "), page_from.cast("string"), F.lit("-"), page_to.cast("string"), F.lit("."))
    )
    first = F.concat(F.lit("From "), title, F.when(tx.empty_if_null(genre) != "", F.concat(F.lit(", a "), genre)).otherwise(F.lit("")), F.lit("."))
    return F.concat_ws(" ", first, F.when(tx.empty_if_null(trail) != "", F.concat(F.lit("Section: "), trail, F.lit("."))), pages)


def allowed_vocabulary(*texts: Column) -> Column:
    """Distinct folded tokens of several texts."""
    return F.array_distinct(F.flatten(F.array(*[tx.folded_tokens(t) for t in texts])))


# ---- plans --------------------------------------------------------------------------------------


def numbered(plan: DataFrame) -> DataFrame:
    """(id, chapter, unit, sub) from (chapter, units: array<struct<title, subs: array<string>>>): ids are ordinals joined by dots."""
    units = plan.select("chapter", F.posexplode("units").alias("u", "unit")).select("chapter", "u", "unit.title", F.posexplode_outer("unit.subs").alias("s", "sub"))
    return units.select(F.concat_ws(".", F.col("chapter").cast("string"), (F.col("u") + 1).cast("string"), (F.col("s") + 1).cast("string")).alias("id"), "chapter", F.col("title").alias("unit"), "sub")


def outline_order(proposed: DataFrame, outline: DataFrame) -> DataFrame:
    """Proposed units (chapter, key, ord) in the order of the outline (chapter, key, pos), others after them."""
    rows = proposed.join(outline.select("chapter", "key", "pos"), ["chapter", "key"], "left")
    return rows.withColumn("place", F.row_number().over(W.partitionBy("chapter").orderBy(F.coalesce("pos", F.lit(1 << 30)), "ord"))).drop("pos")


def orphans(plan: DataFrame, known: DataFrame) -> DataFrame:
    """(chapter, planned, missing): known keys in a plan (chapter, keys), and those that its last section must take."""
    k = known.groupBy("chapter").agg(F.array_sort(F.collect_set("key")).alias("_known"))
    rows = plan.groupBy("chapter").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys")).join(k, "chapter")
    return rows.select("chapter", F.array_sort(F.array_intersect("keys", "_known")).alias("planned"), F.array_except("_known", "keys").alias("missing"))


def merged_references(hits: DataFrame, most: int = 800) -> DataFrame:
    """(unit, source, trail, n, score, page_start, page_end, excerpt): hits (unit, source, trail, rank, ...) as references."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), " … ")
    agg = hits.groupBy("unit", "source", "trail").agg(F.count("*").alias("n"), F.max("score").alias("score"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), text.alias("excerpt"))
    return agg.withColumn("excerpt", F.substring("excerpt", 1, most))


def citation_plan(units: DataFrame, references: DataFrame) -> DataFrame:
    """(unit, n, n_sources, years, gap): what is wrong with the references of each unit, units without any included."""
    years = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.regexp_extract_all("excerpt", F.lit(f"({YEAR})"), F.lit(1))))))
    agg = references.groupBy("unit").agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"), years.alias("years"))
    rows = units.join(agg, "unit", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "n_sources": F.coalesce("n_sources", F.lit(0))})
    return rows.withColumn("gap", F.when(F.col("n") == 0, "no reference").when(F.col("n") < 3, "thin").when(F.col("n_sources") == 1, "single source"))


def first_references(references: DataFrame) -> DataFrame:
    """The best reference of each unit and source."""
    r = F.row_number().over(W.partitionBy("unit", "source").orderBy(F.desc("score"), "trail"))
    return references.withColumn("_r", r).filter("_r = 1").drop("_r")


def figure_captions(rows: DataFrame, most: int = 8) -> DataFrame:
    """(unit, rank, caption): distinct captions in order, ignoring case."""
    c = rows.select("unit", "pos", F.posexplode(F.regexp_extract_all("text", F.lit(CAPTION), F.lit(1))).alias("i", "caption")).withColumn("key", F.lower(F.trim("caption")))
    first = c.groupBy("unit", "key").agg(F.min_by("caption", F.struct("pos", "i")).alias("caption"), F.min(F.struct("pos", "i")).alias("at"))
    return first.withColumn("rank", F.row_number().over(W.partitionBy("unit").orderBy("at"))).filter(F.col("rank") <= most).select("unit", "rank", F.trim("caption").alias("caption"))


def coverage(units: DataFrame) -> DataFrame:
    """Counts by chapter with a grand total, whose chapter is null; units: (chapter, unit, n, gap)."""
    return units.rollup("chapter").agg(F.count("*").alias("units"), F.sum("n").alias("references"), F.count_if(F.col("gap").isNotNull()).alias("gaps"))


# ---- drafts -------------------------------------------------------------------------------------


def evidence_text(rows: DataFrame) -> DataFrame:
    """(chapter, sub, evidence): passages of each sub-topic as a prompt shows them; rows: (chapter, sub, sub_ord, status, pos, id, label, text)."""
    item = F.concat(F.lit("["), "id", F.lit("] "), "label", F.lit("\n"), "text")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", item.alias("t"))))), lambda x: x["t"]), "\n\n")
    note = F.when(F.col("status") == "GAP", "No evidence was found.").when(F.col("status") == "THIN", "The evidence is thin.")
    return rows.groupBy("chapter", "sub", "sub_ord", "status").agg(body.alias("b")).select("chapter", "sub", F.concat_ws("\n", F.concat(F.lit("## "), "sub"), note, "b").alias("evidence"))


def with_neighbours(sections: DataFrame, chars: int = 700) -> DataFrame:
    """sections (chapter, section, text) with the end of the one before and the start of the one after."""
    w = W.partitionBy("chapter").orderBy("section")
    return sections.withColumn("before", F.expr(f"right(lag(text) over (partition by chapter order by section), {chars})")).withColumn("after", F.substring(F.lead("text").over(w), 1, chars))


def segments(text: Column, size: int = 9000) -> Column:
    """A text in pieces of a size, for extraction."""
    t = tx.empty_if_null(text)
    return F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t), F.lit(size)), lambda i: F.substring(t, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def claim_candidates(chunks: DataFrame, mentions: DataFrame, limit: int, least: int = 500) -> DataFrame:
    """Long rows, those with most entities first."""
    n = mentions.groupBy(F.col("chunk_id").alias("rowid")).agg(F.countDistinct("entity_id").alias("entities"))
    return chunks.filter(F.length("text") > least).join(n, "rowid").orderBy(F.desc("entities"), "rowid").limit(limit)


def systematic_sample(rows: DataFrame, step: int, n: int, order: str) -> DataFrame:
    """Every step-th row, the first n of these: a sampling operator."""
    placed = numbering.numbered(rows, [order], name="_r", start=0)
    return placed.filter(F.col("_r") % step == 0).orderBy("_r").limit(n).drop("_r")


# ---- page work ----------------------------------------------------------------------------------


def missing_pages(total: DataFrame, done: DataFrame, batch: int = 100) -> DataFrame:
    """(source, page, batch): pages that aren't done, in batches."""
    want = total.select("source", F.explode(F.expr("sequence(1, total)")).alias("page")).join(done.select("source", "page"), ["source", "page"], "left_anti")
    return want.withColumn("batch", F.floor((F.row_number().over(W.partitionBy("source").orderBy("page")) - 1) / batch).cast("int"))


def collected_pages(results: DataFrame) -> DataFrame:
    """(source, page, text): the last success of each page over all batches."""
    return results.filter("status = 'ok'").groupBy("source", "page").agg(F.max_by("text", "batch_ord").alias("text"))


def book_page(text: Column) -> Column:
    """The printed number on a page: the first line that is a number of two or three digits."""
    return F.nullif(F.regexp_extract(text, r"(?m)^\s*(\d{2,3})\s*$", 1), F.lit("")).cast("int")


def chapter_of_lines(lines: DataFrame, headings: DataFrame) -> DataFrame:
    """lines (doc, pos, text) with chapter: that of the last heading before.

    Headings (doc, chapter, title) count at the first line that starts with them, and only while places ascend with chapters.
    """
    at = lines.join(headings, "doc").filter(tx.strip(F.col("text")).startswith(F.col("title"))).groupBy("doc", "chapter").agg(F.min("pos").alias("pos"))
    before = F.max("pos").over(W.partitionBy("doc").orderBy("chapter").rowsBetween(W.unboundedPreceding, -1))
    at = at.withColumn("_b", before).filter("_b is null or pos > _b").select("doc", "pos", F.col("chapter").alias("_c"))
    return lines.join(at, ["doc", "pos"], "left").withColumn("chapter", F.last("_c", True).over(W.partitionBy("doc").orderBy("pos"))).drop("_c")


def page_marks_whole(text: Column) -> Column:
    """Are the page marks of a text 1, 2, 3 and so on without a gap?"""
    n = F.transform(F.regexp_extract_all(tx.empty_if_null(text), F.lit(r"<!--\s*page\s+(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    return F.when(F.size(n) == 0, F.lit(True)).otherwise(n == F.sequence(F.lit(1), F.greatest(F.size(n), F.lit(1))))


def interleaved(text: Column, transliterate) -> Column:
    """Below each Devanagari line its transliteration, by a Column function."""
    lines = F.split(tx.empty_if_null(text), "\n")
    return F.array_join(F.flatten(F.transform(lines, lambda x: F.when(tx.has_devanagari(x), F.array(x, transliterate(x))).otherwise(F.array(x)))), "\n")


def output_path(path: Column, root: str, to: str) -> Column:
    return F.regexp_replace(F.replace(path, F.lit(root.rstrip("/")), F.lit(to.rstrip("/"))), r"\.[^./]+$", ".md")


def part_key(path: Column, length: Column, modified: Column, model: str, chunk_mb: float, page_cap: int) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", path, length.cast("string"), modified.cast("string"), F.lit(model), F.lit(str(chunk_mb)), F.lit(str(page_cap))).cast("binary")), 1, 16)
