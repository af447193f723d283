"""Manuscript checks over chapters: concepts, repetition, cross references, exemplars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions.text import let

XREF = (
    r"(?i)\b(?:(as (?:we (?:saw|have seen)|noted|discussed|described|shown)(?: (?:above|earlier|in chapter (\d+)))?|discussed (?:above|earlier)|(?:in|see) (?:the )?(?:previous|preceding|earlier) chapter|chapter (\d+) (?:showed|described|discussed))"
    r"|((?:as )?(?:we (?:shall|will) see|will be (?:discussed|described)|discussed (?:below|later))|(?:in|see) (?:the )?(?:next|following|later) chapter)|(?:see |in )?chapter (\d+))"
)
EXPLAINS = r"(?i)\b(?:is|was|were|are|refers to|means|denotes|known as|so called|that is|namely|consists of|comprises|describes|designates)\b"


def paragraphs(text: Column, least: int = 120) -> Column:
    return F.filter(F.split(F.element_at(F.split(F.coalesce(text, F.lit("")), "## Notes"), 1), r"\n\s*\n"), lambda p: F.length(F.trim(p)) > least)


def sentences(text: Column, least: int = 40) -> Column:
    body = F.regexp_replace(F.element_at(F.split(F.coalesce(text, F.lit("")), "## Notes"), 1), r"(?m)^#{1,6} .*$", "")
    return F.filter(F.split(body, r"(?<=[.!?])\s+(?=[A-ZÀ-ɏ])"), lambda s: F.length(F.trim(s)) > least)


def concept_ledger(mentioned: DataFrame, min_chapters: int = 3) -> DataFrame:
    """(entity_id, n_mentioned, n_substantive, first_mention, first_substantive, redundant, forward) from rows
    (entity_id, chapter, substantive): explained in many chapters, or used before it is explained."""
    agg = mentioned.groupBy("entity_id").agg(
        F.countDistinct("chapter").alias("n_mentioned"), F.countDistinct(F.when(F.col("substantive"), F.col("chapter"))).alias("n_substantive"),
        F.min("chapter").alias("first_mention"), F.min(F.when(F.col("substantive"), F.col("chapter"))).alias("first_substantive"),
    )
    return agg.withColumn("redundant", F.col("n_substantive") >= min_chapters).withColumn("forward", F.coalesce(F.col("first_mention") < F.col("first_substantive"), F.lit(False)))


def chapter_mentions(chapters: DataFrame, aliases: DataFrame) -> DataFrame:
    """(entity_id, chapter, substantive): substantive where a paragraph that mentions it also explains."""
    from .entities import mentions

    p = chapters.select("chapter", F.posexplode(paragraphs(F.col("text"))).alias("i", "text")).withColumn("rowid", F.concat_ws(":", "chapter", "i"))
    m = mentions(p, aliases).join(p.select(F.col("rowid").alias("chunk_id"), "chapter", F.col("text").rlike(EXPLAINS).alias("explains")), "chunk_id")
    return m.groupBy("entity_id", "chapter").agg(F.max("explains").alias("substantive"))


def ngrams(words: Column, n: int) -> Column:
    def of(w: Column) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return let(words, of)


def repeated_ngrams(sections: DataFrame, n: int = 10) -> DataFrame:
    """(gram, first_section, n_sections) of word n-grams that come in more than one section; sections: (section, words).

    Hashes are counted first; words go only to the first section of those that are shared.
    """
    def hashes(w: Column) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.slice(w, i, n)))).otherwise(F.array().cast("array<bigint>"))

    hashed = sections.select("section", "words", let(F.col("words"), hashes).alias("hashes"))
    counted = hashed.select("section", F.explode(F.array_distinct("hashes")).alias("h")).groupBy("h").agg(F.min("section").alias("first_section"), F.count("*").alias("n_sections")).filter("n_sections > 1")
    # Of each shared one its place in the first section that has it.
    at = hashed.select(F.col("section").alias("first_section"), F.posexplode("hashes").alias("pos", "h")).join(counted, ["first_section", "h"])
    at = at.groupBy("h", "first_section", "n_sections").agg(F.min("pos").alias("pos"))
    with_words = at.join(sections.select(F.col("section").alias("first_section"), "words"), "first_section")
    return with_words.select(F.array_join(F.slice("words", F.col("pos") + 1, F.lit(n)), " ").alias("gram"), "first_section", "n_sections")


def cross_references(chapters: DataFrame) -> DataFrame:
    """(chapter, pos, phrase, direction, target, problem): phrases that point to other chapters."""
    t = F.coalesce("text", F.lit(""))
    group = lambda i: F.regexp_extract_all(t, F.lit(XREF), F.lit(i))
    z = F.arrays_zip(group(0).alias("p"), group(1).alias("b"), group(2).alias("b1"), group(3).alias("b2"), group(4).alias("f"), group(5).alias("e"))
    rows = chapters.select("chapter", F.posexplode(z).alias("pos", "z"))
    target = F.coalesce(*[F.expr(f"try_cast(nullif(z.{c}, '') as int)") for c in ("b1", "b2", "e")])
    direction = F.when(F.col("z.f") != "", "forward").when(F.col("z.b") != "", "backward").when(target.isNotNull(), "explicit").otherwise("unclear")
    rows = rows.select("chapter", "pos", F.col("z.p").alias("phrase"), direction.alias("direction"), target.alias("target"))
    have = chapters.select(F.col("chapter").alias("_c")).distinct()
    ends = chapters.agg(F.min("chapter").alias("_lo"), F.max("chapter").alias("_hi"))
    rows = rows.join(have, F.col("target") == F.col("_c"), "left").crossJoin(F.broadcast(ends))
    problem = (
        F.when(F.col("target").isNotNull() & F.col("_c").isNull(), "no such chapter")
        .when((F.col("direction") == "forward") & (F.col("chapter") == F.col("_hi")), "forward from the last chapter")
        .when((F.col("direction") == "backward") & (F.col("chapter") == F.col("_lo")), "backward from the first chapter")
        .when((F.col("direction") == "backward") & (F.col("target") > F.col("chapter")), "backward to a later chapter")
    )
    return rows.withColumn("problem", problem).drop("_c", "_lo", "_hi")


def style_exemplars(chapters: DataFrame, n: int = 2, least: int = 90, most: int = 190) -> DataFrame:
    """(chapter, rank, score, paragraph): of suitable length, by citations and variety of sentence length."""
    rows = chapters.select("chapter", F.posexplode(paragraphs(F.col("text"))).alias("i", "paragraph"))
    words = lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))
    rows = rows.filter(words(F.col("paragraph")).between(least, most))
    lengths = F.transform(F.split("paragraph", r"(?<=[.!?])\s+"), words)
    score = F.regexp_count("paragraph", F.lit(r"\[\d+\]")) + (F.array_max(lengths) - F.array_min(lengths)) / 10
    rank = F.row_number().over(W.partitionBy("chapter").orderBy(F.desc("score"), "i"))
    return rows.withColumn("score", score).withColumn("rank", rank).filter(F.col("rank") <= n).select("chapter", "rank", "score", "paragraph")
