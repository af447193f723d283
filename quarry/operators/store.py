"""A store of tables: rows, an index that is written once and read pruned, lookups, statistics, stamps.

The index is what scoring needs of a corpus without its texts.  Lists of tokens lie in buckets by a hash of
the token, so a query reads the folders of its terms only; inside a file lists are in order of token, so row
groups are skipped by their statistics.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import config
from ..functions import numeric
from . import retrieval as rt

BUCKETS = 64
#: Keys that a lookup compares as literals; more are joined.
LITERALS = 200


# ---- the index ----------------------------------------------------------------------------------


def bucket(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.crc32(token.cast("binary")), F.lit(buckets)).cast("int")


def write_index(rows: DataFrame, streams: dict[str, Column], path: str, vectors: DataFrame | None = None, id_col: str = "rowid", buckets: int = BUCKETS) -> None:
    """postings, lengths and, if given, unit vectors (rowid, embedding) under path."""
    lists = rt.postings(rows, streams, id_col).withColumn("bucket", bucket(F.col("token"), buckets))
    lists.repartition("bucket", "token").sortWithinPartitions("bucket", "token", "stream", "rowid").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")
    rt.doc_lengths(rows, streams, id_col).write.mode("overwrite").parquet(f"{path}/lengths")
    if vectors is not None:
        vectors.select("rowid", numeric.normalised(F.col("embedding")).alias("embedding")).write.mode("overwrite").parquet(f"{path}/vectors")


def read_index(spark: SparkSession, path: str, terms: DataFrame | None = None, most_terms: int = 10_000, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(postings, lengths); with terms (term) only the buckets that these are in are listed, if they are few."""
    lists, lengths = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/lengths")
    if terms is not None:
        wanted = terms.select(bucket(F.col("term"), buckets).alias("b")).distinct()
        some = [r["b"] for r in wanted.collect()]  # at most as many as there are buckets
        lists = lists.filter(F.col("bucket").isin(some))
        few = terms.select("term").distinct().limit(LITERALS + 1).collect()
        if len(few) <= LITERALS:
            lists = lists.filter(F.col("token").isin([r["term"] for r in few]))
    return lists.drop("bucket"), lengths


def search(spark: SparkSession, path: str, terms: DataFrame, k: int = 10, weights: dict[str, float] = rt.WEIGHTS) -> DataFrame:
    """(qid, rowid, rank, score) of query terms (qid, stream, term) by the written index; no text is read."""
    lists, lengths = read_index(spark, path, terms)
    return rt.top_k(rt.bm25(lists, lengths, terms, weights).withColumn("score", F.round("score", 5)), k).select("qid", "rowid", "rank", "score")


# ---- lookups ------------------------------------------------------------------------------------


def lookup(rows: DataFrame, key, id_col: str = "rowid") -> DataFrame:
    """The row of a key, or none."""
    return rows.filter(F.col(id_col) == F.lit(key))


def lookup_all(rows: DataFrame, keys: DataFrame | list, id_col: str = "rowid") -> DataFrame:
    """The rows of keys, in no order; missing keys are silently absent, no keys give no rows."""
    if isinstance(keys, list):
        if len(keys) <= LITERALS:
            return rows.filter(F.col(id_col).isin(keys)) if keys else rows.limit(0)
        keys = rows.sparkSession.createDataFrame([(k,) for k in keys], f"`{id_col}` {dict(rows.dtypes)[id_col]}")
    return rows.join(keys.select(id_col).distinct(), id_col, "left_semi")


def probed(wanted: DataFrame, cache: DataFrame, keys: list[str], value: str = "score") -> tuple[DataFrame, DataFrame]:
    """wanted with the cached value, null where there is none; one row (hits, misses)."""
    found = wanted.join(cache.select(*keys, value), keys, "left")
    return found, found.agg(F.count_if(F.col(value).isNotNull()).alias("hits"), F.count_if(F.col(value).isNull()).alias("misses"))


def labels_by_chunk(labels: DataFrame) -> DataFrame:
    """One row of labels for each chunk: the last of several by time of labelling."""
    order = F.col("labelled_at") if "labelled_at" in labels.columns else F.col("chunk_id")
    rest = [c for c in labels.columns if c != "chunk_id"]
    return labels.groupBy("chunk_id").agg(F.max_by(F.struct(*rest), order).alias("l")).select("chunk_id", *[F.col(f"l.{c}").alias(c) for c in rest])


# ---- statistics and stamps ----------------------------------------------------------------------


def statistics(chunks: DataFrame, sources: DataFrame, entities: DataFrame, aliases: DataFrame, mentions: DataFrame, claims: DataFrame) -> DataFrame:
    """One row of counts over the tables of a store."""
    def one(df: DataFrame, **counts: Column) -> DataFrame:
        return df.agg(*[c.alias(n) for n, c in counts.items()])

    n = F.count("*")
    parts = [
        one(chunks, chunks=n, with_context=F.count_if(F.coalesce("context", F.lit("")) != "")), one(sources, sources=n), one(entities, entities=n, curated_entities=F.count_if("curated")),
        one(aliases, aliases=n), one(mentions, mentions=n), one(claims, claims_corpus=F.count_if(F.col("scope") == "corpus"), claims_manuscript=F.count_if(F.col("scope") == "manuscript")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


#: Sections of the settings that shape what is retrieved.
SHAPING = ("chunking", "index", "fusion", "rerank", "labels")


def stamp(built: dict, cfg: dict) -> dict:
    """Identity of a build and of the settings that shape packs; other settings may change without it.

    built: fingerprint, built_at, count and model of the index.
    """
    shaping = config.section_hash(cfg, *SHAPING)
    ident = {k: built.get(k) for k in ("fingerprint", "built_at", "count", "model")} | {"config": shaping}
    return {k: built.get(k) for k in ("built_at", "count", "model")} | {"config": shaping, "full_config": config.config_hash(cfg), "contextualized": bool(built.get("contextualized")), "hash": config.config_hash(ident)}


def save_stamp(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_stamp(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))  # one line
