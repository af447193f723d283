"""What is known of sources: names to cite them by, kind, contribution, and what model-made records propose.

A dictionary of sources is a table (source, short, full) that people keep; a classification is one of
(source, kind, contribution).  Both are small and joined; the join is broadcast if their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx

#: Sources that nobody classified.
KIND, CONTRIBUTION = "secondary", "Unclassified: add it to the classification"


def plain_name(source: Column) -> Column:
    """A file name without its ending, dashes and underscores as blanks, in italics."""
    stem = F.regexp_replace(source, r"\.[^.]*$", "")
    return F.concat(F.lit("*"), F.trim(F.translate(stem, "_-", "  ")), F.lit("*"))


def named(rows: DataFrame, dictionary: DataFrame, source: str = "source") -> DataFrame:
    """rows with short and full, from the dictionary or made of the file name."""
    d = dictionary.select(F.col("source").alias("_source"), F.col("short").alias("_short"), F.col("full").alias("_full"))
    out = rows.join(d, F.col(source) == F.col("_source"), "left")
    fallback = plain_name(F.col(source))
    return out.withColumn("short", F.coalesce(F.nullif("_short", F.lit("")), fallback)).withColumn("full", F.coalesce(F.nullif("_full", F.lit("")), fallback)).drop("_source", "_short", "_full")


def classified(rows: DataFrame, classification: DataFrame, source: str = "source") -> DataFrame:
    """rows with kind and contribution, defaults where there is no classification."""
    c = classification.select(F.col("source").alias("_source"), F.col("kind").alias("_kind"), F.col("contribution").alias("_contribution"))
    out = rows.join(c, F.col(source) == F.col("_source"), "left")
    return out.withColumn("kind", F.coalesce("_kind", F.lit(KIND))).withColumn("contribution", F.coalesce("_contribution", F.lit(CONTRIBUTION))).drop("_source", "_kind", "_contribution")


def unmapped(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(source) of rows that the dictionary lacks, in order."""
    return rows.select("source").distinct().join(dictionary.select("source"), "source", "left_anti").orderBy("source")


def normalised_authors(rows: DataFrame, authors: DataFrame, column: str = "author") -> DataFrame:
    """rows with the author's usual name: authors (folded, name) by folded surface, else trimmed."""
    a = authors.select(F.col("folded").alias("_folded"), "name")
    return rows.join(a, tx.fold(F.col(column)) == F.col("_folded"), "left").withColumn(column, F.coalesce("name", F.trim(column))).drop("_folded", "name")


def synchronised(dossiers: DataFrame, classification: DataFrame, summary_chars: int = 4000) -> tuple[DataFrame, DataFrame]:
    """Source rows from dossiers, and (source, proposed, curated) where a person's kind and the dossier's differ.

    The curated kind wins; all else comes from the dossier.
    """
    c = classification.select("source", F.col("kind").alias("curated"))
    d = dossiers.withColumnRenamed("kind", "proposed").join(c, "source", "left")
    rows = d.select(
        "source", F.coalesce("curated", "proposed").alias("kind"), "genre", F.col("coverage.period_from").alias("period_from"), F.col("coverage.period_to").alias("period_to"),
        F.coalesce("coverage.geography", F.array().cast("array<string>")).alias("geography"), F.coalesce("stance", F.lit("")).alias("stance"),
        F.coalesce("reliability_notes", F.array().cast("array<string>")).alias("reliability"), F.substring(F.coalesce("summary", F.lit("")), 1, summary_chars).alias("summary"),
    )
    return rows, d.filter("curated <> proposed").select("source", "proposed", "curated")


def proposals(dossiers: DataFrame) -> DataFrame:
    """(source, short, full): entries for the dictionary, to be confirmed by a person."""
    i = F.col("identity")
    author, publisher = F.trim(F.coalesce(i["author"], F.lit(""))), F.trim(F.coalesce(i["publisher"], F.lit("")))
    title = F.concat(F.lit("*"), F.trim(F.coalesce(F.nullif(i["title"], F.lit("")), F.col("source"))), F.lit("*"))
    some = lambda c: F.nullif(c, F.lit(""))
    short = F.concat_ws(", ", some(F.element_at(F.split(author, ","), 1)), title)
    full = F.concat(F.concat_ws(", ", some(author), title, some(publisher), F.nullif(i["year"], F.lit(0)).cast("string")), F.lit("."))
    return dossiers.select("source", short.alias("short"), full.alias("full")).orderBy("source")


def anchored(chapters: DataFrame, anchors: DataFrame, default: str) -> DataFrame:
    """chapters with the anchor of their queries: anchors (chapter, anchor), else the default."""
    return chapters.join(anchors, "chapter", "left").withColumn("anchor", F.coalesce("anchor", F.lit(default)))
