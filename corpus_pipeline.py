"""The corpus pipeline: quality rules, near-duplicate join, secret scan, mixing, BPE coding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its decisions take effect
on the rows that the next stage reads.  All but the last return the columns of docs.

In every stage a null text counts as an empty one, a text of any length is worked on whole, columns beside doc_id, source and text are
carried along whatever their names (the last stage leaves them behind), and an empty table gives an empty table.  What stages
do with null ids, repeated rows and ties is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import bpe, jaccard_join, mixing, quality_rules, secrets
from quarry.llm.common import drop_written, fresh_prefix, prepare, table, written


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the classifier reject go; empty texts are among them.

    Each row is judged by its text alone: rows without an id and rows that repeat one are judged like others, equal texts alike.
    """
    prepare(spark)
    model = quality_rules.model_for(docs, table(spark, sf_dir, "labels"))
    own = fresh_prefix(docs, "rules_")
    return quality_rules.judge(docs, model, prefix=own).filter(F.col(own + "kept")).select(*docs.columns)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays.

    Texts without words are linked with nothing and stay.  Rows without an id stay; rows that repeat the id that stays, stay.
    """
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays, null texts as they are.

    Of overlapping spans the marks cover all; ids play no part, so null and repeated ones stay as they are.
    """
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    A null source is a source.  Null ids share one key, rows that repeat an id share its key, and rows whose keys tie are taken
    together.  Texts without words are not taken.
    """
    return mixing.mixed_rows(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, token_ids, decoded) of every row: ids as little-endian 32-bit integers, and what they decode to.

    Rows without an id and rows that the mix has taken more than once are coded each; equal texts get equal ids.
    """
    prepare(spark)
    coded = bpe.encode(docs.select("doc_id", "source", "text"), bpe.public_tokenizer())
    return coded.select("doc_id", "source", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("jaccard_join", jaccard_join_stage),
    ("secret_scans", secret_scan_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The classifier of the first stage can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_written(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
