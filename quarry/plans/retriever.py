"""A retriever over tables: questions in, packs of passages with a status out, as one plan for any number of questions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import config
from ..functions import text as tx
from ..operators import entities as en, models, retrieval as rt


@dataclass
class Retriever:
    """chunks (rowid, source, text); the other tables are optional, and so are their channels.

    vectors (rowid, embedding); registry (entity_id, canonical, type, aliases, curated); sources (source, kind...);
    labels (chunk_id, retrievable, quality...); client: a factory of model clients, for embeddings of queries.
    """

    chunks: DataFrame
    vectors: DataFrame | None = None
    registry: DataFrame | None = None
    sources: DataFrame | None = None
    labels: DataFrame | None = None
    client: Callable[[], models.ModelClient] = models.StubClient
    cfg: dict = field(default_factory=lambda: config.DEFAULTS)
    pairs: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        streams = {"raw": tx.tokens(F.col("text")), "folded": tx.folded_words(F.col("text"))}
        self.aliases = en.aliases(en.normalised_registry(self.registry)) if self.registry is not None else None
        self.mentions = en.mentions(self.chunks, self.aliases) if self.aliases is not None else None
        rows = self.chunks
        if self.mentions is not None:
            rows = rows.join(en.entity_stream(self.mentions, self.aliases), F.col("rowid") == F.col("chunk_id"), "left")
            streams["ents"] = F.coalesce("stream", F.array().cast("array<string>"))
        self.index, self.lengths = rt.postings(rows, streams), rt.doc_lengths(rows, streams)

    def allowed(self, **filters) -> DataFrame:
        return rt.allowed_rows(self.chunks, self.sources, self.labels, **filters)

    def sparse(self, queries: DataFrame, k: int, allowed: DataFrame) -> DataFrame:
        keyed = queries.withColumn("qid", F.struct("sub", "query_ord"))
        scored = rt.bm25(self.index, self.lengths, rt.query_terms(keyed), {k: w for k, w in rt.WEIGHTS.items() if k != "deva"}).join(allowed, "rowid", "left_semi")
        return rt.top_k(scored.withColumn("score", F.round("score", 9)), k).select("qid.sub", F.lit("sparse").alias("channel"), "qid.query_ord", "rowid", "rank")

    def dense(self, queries: DataFrame, k: int, allowed: DataFrame) -> DataFrame:
        embedded = models.embed(queries, self.client, "query").select(F.struct("sub", "query_ord").alias("qid"), "embedding")
        return rt.top_k(rt.dense_scores(embedded, self.vectors, allowed), k).select("qid.sub", F.lit("dense").alias("channel"), "qid.query_ord", "rowid", "rank", "score")

    def entity(self, queries: DataFrame, k: int, allowed: DataFrame) -> DataFrame:
        terms = queries.select("sub", F.explode(tx.words(F.col("query"))).alias("term")).distinct()
        found = en.resolve(terms, self.aliases).filter("entity_id is not null").select(F.col("sub").alias("qid"), "entity_id")
        scored = rt.entity_scores(found, self.mentions, allowed)
        return rt.top_k(scored, k).select(F.col("qid").alias("sub"), F.lit("entity").alias("channel"), F.lit(0).alias("query_ord"), "rowid", "rank")

    def packs(self, queries: DataFrame, k: int = 60, backend: str = "none", scores: DataFrame | None = None, **filters) -> tuple[DataFrame, DataFrame]:
        """queries (sub, query_ord, query): the kept passages with places, and the status of every sub-topic.

        scores (sub, rowid, score) are a reranker's, named by backend; without any the fused order is scored flat.
        """
        allowed, columns = self.allowed(**filters), ["sub", "channel", "query_ord", "rowid", "rank"]
        parts, dense = [self.sparse(queries, k, allowed)], None
        if self.vectors is not None:
            d = self.dense(queries, k, allowed)
            parts.append(d.select(columns))
            dense = d.groupBy("sub", "rowid").agg(F.max("score").alias("score"))
        if self.mentions is not None:
            parts.append(self.entity(queries, k, allowed))
        channels = reduce(DataFrame.unionByName, parts)
        kept = rt.funnel(channels, self.chunks, self.cfg["fusion"]["weights"], backend, scores, dense, self.cfg["pack"]["keep"], self.pairs)
        status = rt.pack_status(queries.select("sub").distinct(), kept, backend in rt.CALIBRATED, self.cfg["pack"]["thin"])
        return kept.join(self.chunks.select("rowid", "text"), "rowid"), status
