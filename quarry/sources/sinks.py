"""Writers: packs, briefs, bibliographies, manuscripts, caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .snapshots import Snapshots


def swap_table(df: DataFrame, path: str, spark: SparkSession) -> None:
    """df becomes the newest version of the table at path; there is a whole table at every moment, and readers of older ones go on."""
    Snapshots(spark, path).update(lambda _: {"table": df})


def current_table(path: str, spark: SparkSession) -> DataFrame:
    """The newest version of a table that swap_table() wrote."""
    found = Snapshots(spark, path).version()
    if found is None:
        raise FileNotFoundError(path)
    return found.table("table")


def packs_json(packs: DataFrame, path: str) -> None:
    packs.write.mode("overwrite").json(path)


def brief(rows: DataFrame) -> DataFrame:
    """(chapter, markdown): passages by sub-topic; one shown before in the chapter is a stub.

    rows: (chapter, sub_ord, sub, status, pos, id, label, text, repeated).
    """
    body = F.when(F.col("repeated"), F.lit("(shown above)")).otherwise(F.col("text"))
    item = F.concat_ws("\n", F.concat(F.lit("### "), "id", F.lit(" "), "label"), body)
    subs = rows.groupBy("chapter", "sub_ord", "sub", "status").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("t")))), lambda x: x["t"]), "\n\n").alias("t"))
    section = F.concat(F.lit("## "), "sub", F.lit(" ["), "status", F.lit("]\n\n"), "t")
    return subs.groupBy("chapter").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub_ord", section.alias("t")))), lambda x: x["t"]), "\n\n").alias("markdown"))


def bibliography(used: DataFrame) -> DataFrame:
    """used sources (full) in order, ignoring case."""
    return used.select("full").distinct().orderBy(F.lower("full"), "full")


def assembled(outline: DataFrame, chapters: DataFrame) -> DataFrame:
    """One row (words, missing, markdown): chapters in the outline's order, a placeholder for each that isn't written."""
    rows = outline.join(chapters, "chapter", "left")
    text = F.coalesce("text", F.concat(F.lit("# "), "title", F.lit("\n\n[not yet written]")))
    words = F.when(F.col("text").isNotNull(), F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))).otherwise(0)
    return rows.agg(F.sum(words).alias("words"), F.count_if(F.col("text").isNull()).alias("missing"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter", text.alias("t")))), lambda x: x["t"]), "\n\n---\n\n").alias("markdown"))


def contents(chapters: DataFrame, level: int = 2) -> DataFrame:
    """(chapter, pos, heading): headings of one level."""
    return chapters.select("chapter", F.posexplode(F.regexp_extract_all("text", F.lit(rf"(?m)^#{{{level}}} +(.+)$"), F.lit(1))).alias("pos", "heading"))


def manifest(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def file_state(inputs: DataFrame, outputs: DataFrame, supported: str = r"(?i)\.(?:pdf|png|jpe?g|tiff?)$") -> DataFrame:
    """inputs (path, modificationTime) with state: unsupported, up-to-date or due; outputs: (path, written, complete)."""
    rows = inputs.join(outputs, "path", "left")
    state = F.when(~F.col("path").rlike(supported), "unsupported").when(F.col("complete") & (F.col("written") >= F.col("modificationTime")), "up-to-date").when(F.col("written").isNotNull() & ~F.coalesce("complete", F.lit(False)), "incomplete").otherwise("due")
    return rows.withColumn("state", state)
