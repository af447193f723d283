"""Retrieval: postings and BM25, dense top-k, entity channel, fusion, floor, diversity, status.

Everything works on tables of queries at once; ranks are window functions over (query), ties go
to the smaller row id, and a query without results keeps a row where a status is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import numeric, text as tx

STREAMS = ("raw", "folded", "deva", "ents")
WEIGHTS = {"raw": 1.0, "folded": 0.7, "deva": 0.8, "ents": 2.0}
K1, B = 1.2, 0.75
RRF_K, RRF_LIMIT = 60, 48
FLOOR = {"hosted": 0.20, "bge": 0.55, "llm": 0.40, "none": 0.0}
MARGIN = {"hosted": 0.45, "bge": 0.15, "llm": 0.25, "none": 0.15}
CALIBRATED = ("hosted", "bge")
DENSE_FLOOR = 0.76


# ---- index --------------------------------------------------------------------------------------


def postings(rows: DataFrame, streams: dict[str, Column], id_col: str = "rowid") -> DataFrame:
    """(rowid, stream, token, tf): streams maps names to Columns of token arrays."""
    parts = [rows.select(F.col(id_col).alias("rowid"), F.lit(s).alias("stream"), F.explode(c).alias("token")) for s, c in streams.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("rowid", "stream", "token").agg(F.count("*").alias("tf"))


def doc_lengths(rows: DataFrame, streams: dict[str, Column], id_col: str = "rowid") -> DataFrame:
    """(rowid, n): tokens over all streams, rows without tokens included."""
    return rows.select(F.col(id_col).alias("rowid"), reduce(lambda a, b: a + b, [F.size(c) for c in streams.values()]).cast("long").alias("n"))


def query_terms(queries: DataFrame, id_col: str = "qid", text_col: str = "query") -> DataFrame:
    """(qid, stream, term): literal tokens for raw and deva, folded ones for folded and ents; one-character tokens go."""
    q = F.col(text_col)
    long = lambda a: F.array_distinct(F.filter(a, lambda x: F.length(x) > 1))
    literal = queries.select(F.col(id_col).alias("qid"), F.explode(long(tx.tokens(q))).alias("term"))
    folded = queries.select(F.col(id_col).alias("qid"), F.explode(long(tx.folded_tokens(q))).alias("term"))
    pair = lambda df, a, b: df.withColumn("stream", F.explode(F.array(F.lit(a), F.lit(b))))
    return pair(literal, "raw", "deva").unionByName(pair(folded, "folded", "ents")).select("qid", "stream", "term")


def bm25(index: DataFrame, lengths: DataFrame, terms: DataFrame, weights: dict[str, float] = WEIGHTS, k1: float = K1, b: float = B) -> DataFrame:
    """(qid, rowid, score).  A term's frequency is summed over its streams by weight before saturation;
    idf is ln((N - n + 0.5) / (n + 0.5)), or 1e-6 where that isn't positive.  A query without terms has no rows.

    The index is read through a semi join on the terms, so scoring sees only lists that are asked for.
    """
    w = F.create_map(*[x for s, v in weights.items() for x in (F.lit(s), F.lit(float(v)))])
    wanted = terms.select("stream", F.col("term").alias("token")).distinct()
    lists = index.join(wanted, ["stream", "token"], "left_semi")
    stats = lengths.agg(F.count("*").alias("n_docs"), F.avg("n").alias("avg_len"))
    # Streams that a term may hit are one phrase: its frequency counts rows with any of them.
    group = F.when(F.col("stream").isin("raw", "deva"), F.lit("literal")).otherwise(F.lit("folded"))
    hits = lists.withColumn("kind", group).groupBy("rowid", "kind", "token").agg(F.sum(F.col("tf") * w[F.col("stream")]).alias("f"))
    df = hits.groupBy("kind", "token").agg(F.count("*").alias("df"))
    asked = terms.withColumn("kind", group).select("qid", "kind", F.col("term").alias("token")).distinct()
    rows = asked.join(hits, ["kind", "token"]).join(df, ["kind", "token"]).join(lengths, "rowid").crossJoin(F.broadcast(stats))
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(idf > 0, idf).otherwise(F.lit(1e-6))
    part = idf * F.col("f") * (k1 + 1) / (F.col("f") + k1 * (1 - b + b * F.col("n") / F.col("avg_len")))
    return rows.groupBy("qid", "rowid").agg(F.sum(part).alias("score"))


def top_k(scored: DataFrame, k: int, by: str = "qid", score: str = "score", tie: str = "rowid") -> DataFrame:
    """The k best rows of each group with rank from 1; Spark prunes groups before the shuffle."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.desc(score), tie))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


# ---- filters ------------------------------------------------------------------------------------


def admitted(
    kind: list[str] | None = None, genre: list[str] | None = None, source: list[str] | None = None, exclude_source: list[str] | None = None,
    structural: list[str] | None = None, evidence_role: list[str] | None = None, content: list[str] | None = None, min_quality: float | None = None,
    period: tuple[int | None, int | None] | None = None, include_junk: bool = False,
) -> Column:
    """One condition from metadata filters.  What is unknown is admitted: quality, period bounds and the gate itself."""
    conds = []
    for name, values in (("kind", kind), ("genre", genre), ("source", source), ("structural", structural), ("evidence_role", evidence_role)):
        if values:
            conds.append(F.col(name).isin(values))
    if exclude_source:
        conds.append(~F.col("source").isin(exclude_source))
    if content:
        conds.append(F.arrays_overlap("content", F.array(*[F.lit(c) for c in content])))
    if min_quality is not None:
        conds.append(F.col("quality").isNull() | (F.col("quality") >= min_quality))
    if period:
        lo, hi = period
        if hi is not None:
            conds.append(F.col("period_from").isNull() | (F.col("period_from") <= hi))
        if lo is not None:
            conds.append(F.col("period_to").isNull() | (F.col("period_to") >= lo))
    if not include_junk:
        conds.append(F.col("retrievable").isNull() | F.col("retrievable"))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def allowed_rows(chunks: DataFrame, sources: DataFrame | None, labels: DataFrame | None, **filters) -> DataFrame:
    """(rowid) that filters admit; left joins, so rows without source data or labels take part."""
    rows = chunks
    if sources is not None:
        rows = rows.join(sources, "source", "left")
    if labels is not None:
        rows = rows.join(labels.withColumnRenamed("chunk_id", "rowid"), "rowid", "left")
    return rows.filter(admitted(**filters)).select("rowid")


def is_retrievable(quality: Column, issues: Column, min_quality: float = 0.45) -> Column:
    return ~F.exists(issues, lambda x: x.startswith("non-evidential")) & (quality >= min_quality)


# ---- dense and entity channels ------------------------------------------------------------------


def dense_scores(queries: DataFrame, vectors: DataFrame, allowed: DataFrame | None = None, vec: str = "embedding") -> DataFrame:
    """(qid, rowid, score): cosine of every query with every admitted row.

    queries: (qid, vec), a batch whose size the caller checks; it is the side that is broadcast.
    """
    rows = vectors if allowed is None else vectors.join(allowed, "rowid", "left_semi")
    unit = lambda df, key: df.select(key, numeric.normalised(F.col(vec)).alias("unit"))
    q, r = unit(queries, "qid").withColumnRenamed("unit", "q"), unit(rows, "rowid").withColumnRenamed("unit", "r")
    return r.crossJoin(F.broadcast(q)).select("qid", "rowid", numeric.dot(F.col("q"), F.col("r")).alias("score"))


def entity_scores(query_entities: DataFrame, mentions: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """(qid, rowid, ents, hits, score): distinct entities of the query that a row mentions, and how often."""
    rows = mentions.withColumnRenamed("chunk_id", "rowid")
    if allowed is not None:
        rows = rows.join(allowed, "rowid", "left_semi")
    hit = rows.join(query_entities.select("qid", "entity_id").distinct(), "entity_id").groupBy("qid", "rowid")
    return hit.agg(F.countDistinct("entity_id").alias("ents"), F.sum("n").alias("hits")).withColumn("score", F.col("ents") + F.col("hits") / 100)


# ---- fusion -------------------------------------------------------------------------------------


def flatten_channel(hits: DataFrame) -> DataFrame:
    """(sub, channel, rowid, rank): best rank over a channel's queries, renumbered from 1; hits carry (query_ord, rank)."""
    best = hits.groupBy("sub", "channel", "rowid").agg(F.min(F.struct("rank", "query_ord")).alias("b"))
    order = W.partitionBy("sub", "channel").orderBy("b.rank", "b.query_ord", "rowid")
    return best.select("sub", "channel", "rowid", F.row_number().over(order).alias("rank"))


def rrf(flat: DataFrame, weights: dict[str, float], k: int = RRF_K, limit: int = RRF_LIMIT) -> DataFrame:
    """(sub, rowid, rrf, ranks, channels, rank): reciprocal rank fusion; a weight of 0 leaves a channel out."""
    w = F.create_map(*[x for c, v in weights.items() for x in (F.lit(c), F.lit(float(v)))])
    rows = flat.withColumn("w", F.coalesce(w[F.col("channel")], F.lit(1.0))).filter("w <> 0")
    parts = F.array_sort(F.collect_list(F.struct("channel", "rank", (F.col("w") / (k + F.col("rank"))).alias("part"))))
    fused = rows.groupBy("sub", "rowid").agg(parts.alias("p"))
    # Added in order of channel, so that sums repeat to the last bit.
    fused = fused.select(
        "sub", "rowid", F.aggregate("p", F.lit(0.0), lambda acc, x: acc + x["part"]).alias("rrf"),
        F.map_from_entries(F.transform("p", lambda x: F.struct(x["channel"], x["rank"]))).alias("ranks"), F.transform("p", lambda x: x["channel"]).alias("channels"),
    )
    return top_k(fused, limit, by="sub", score="rrf")


def channel_report(fused: DataFrame, top: int = 10) -> DataFrame:
    """(channel, present, alone): in how many of the top rows a channel takes part, and is the only one."""
    rows = fused.filter(F.col("rank") <= top).select(F.explode("channels").alias("channel"), (F.size("channels") == 1).alias("one"))
    return rows.groupBy("channel").agg(F.count("*").alias("present"), F.count_if("one").alias("alone"))


def rerank(fused: DataFrame, cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """fused with score: from the cache (qhash, rowid, score) where it has one, else from fresh of the same form."""
    c = cache.select("qhash", "rowid", F.col("score").alias("cached"))
    f = fresh.select("qhash", "rowid", F.col("score").alias("fresh"))
    return fused.join(c, ["qhash", "rowid"], "left").join(f, ["qhash", "rowid"], "left").withColumn("score", F.coalesce("cached", "fresh")).drop("cached", "fresh")


def flat_scores(rows: DataFrame, by: str = "sub", order: str = "rank") -> DataFrame:
    """Scores that keep the incoming order: 1 - i / n."""
    w = W.partitionBy(by)
    return rows.withColumn("score", 1.0 - (F.row_number().over(w.orderBy(order)) - 1) / F.count("*").over(w))


def relevance_floor(rows: DataFrame, backend: str, by: str = "sub", score: str = "score", dense: str = "dense") -> DataFrame:
    """rows with floor that reach it.  Calibrated scores meet max(absolute, top - margin); others top - margin,
    after rows whose dense score is known and below a floor are gone."""
    top = F.max(score).over(W.partitionBy(by))
    if backend in CALIBRATED:
        rows = rows.withColumn("floor", F.greatest(F.lit(FLOOR[backend]), top - MARGIN[backend]))
    else:
        rows = rows.filter(F.col(dense).isNull() | (F.col(dense) >= DENSE_FLOOR)).withColumn("floor", top - MARGIN.get(backend, MARGIN["none"]))
    return rows.filter(F.col(score) >= F.col("floor"))


def source_groups(rows: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """rows with source_group: a source and its translations share one."""
    if not pairs:
        return rows.withColumn("source_group", F.col("source"))
    m = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return rows.withColumn("source_group", F.coalesce(m[F.col("source")], F.col("source")))


def diversity_cap(rows: DataFrame, keep: int, share: float = 0.5, least: int = 3, by: str = "sub", group: str = "source_group", score: str = "score") -> DataFrame:
    """The keep best of each query with at most max(least, keep * share) of a group while others are left, with pos from 0.

    Greedy selection with backfill is the same as ordering by (is the row beyond its group's cap, rank).
    """
    cap = max(least, int(keep * share))
    in_group = F.row_number().over(W.partitionBy(by, group).orderBy(F.desc(score), "rowid"))
    rows = rows.withColumn("over", in_group > cap)
    rows = rows.withColumn("pick", F.row_number().over(W.partitionBy(by).orderBy("over", F.desc(score), "rowid"))).filter(F.col("pick") <= keep)
    return rows.withColumn("pos", F.row_number().over(W.partitionBy(by).orderBy(F.desc(score), "rowid")) - 1).drop("over", "pick")


def lost_in_middle(rows: DataFrame, by: str = "sub", pos: str = "pos") -> DataFrame:
    """rows with shown: best at both ends, from four rows on."""
    n = F.count("*").over(W.partitionBy(by))
    i = F.col(pos)
    shown = F.when(n < 4, i).when(i % 2 == 0, F.floor(i / 2)).otherwise(n - 1 - F.floor((i - 1) / 2))
    return rows.withColumn("shown", shown.cast("int"))


def pack_status(subs: DataFrame, kept: DataFrame, calibrated: bool, thin: int = 3, thin_top: float = 0.35) -> DataFrame:
    """(sub, n_kept, n_sources, top, status) of every sub-topic, those without rows included."""
    agg = kept.groupBy("sub").agg(F.count("*").alias("n_kept"), F.countDistinct("source").alias("n_sources"), F.max("score").alias("top"))
    rows = subs.select("sub").join(agg, "sub", "left").withColumns({"n_kept": F.coalesce("n_kept", F.lit(0)), "n_sources": F.coalesce("n_sources", F.lit(0))})
    status = F.when(F.col("n_kept") == 0, "GAP").when(F.col("n_kept") < thin, "THIN")
    if calibrated:
        status = status.when(F.col("top") < thin_top, "THIN")
    return rows.withColumn("status", status.when(F.col("n_sources") == 1, "SINGLE-SOURCE").otherwise("OK"))


def partial_status(status: DataFrame, unevidenced: DataFrame) -> DataFrame:
    """OK becomes PARTIAL where terms of the question are not attested: unevidenced (sub, absent array)."""
    rows = status.join(unevidenced.select("sub", "absent"), "sub", "left")
    return rows.withColumn("status", F.when((F.col("status") == "OK") & (F.size(F.coalesce("absent", F.array())) > 0), "PARTIAL").otherwise(F.col("status")))


def capped_out(floored: DataFrame, kept: DataFrame, limit: int = 10) -> DataFrame:
    """Up to `limit` rows of each sub-topic that reached the floor but weren't kept."""
    return top_k(floored.join(kept.select("sub", "rowid"), ["sub", "rowid"], "left_anti"), limit, by="sub")


def funnel(channels: DataFrame, meta: DataFrame, weights: dict[str, float], backend: str, scores: DataFrame | None = None, dense: DataFrame | None = None, keep: int = 10, pairs: dict[str, str] | None = None) -> DataFrame:
    """The whole chain as one plan: flatten, fuse, score, floor, cap, reorder.

    channels: (sub, channel, query_ord, rowid, rank); meta: (rowid, source); scores, dense: (sub, rowid, score).
    """
    fused = rrf(flatten_channel(channels), weights)
    rows = flat_scores(fused) if scores is None else fused.join(scores.select("sub", "rowid", "score"), ["sub", "rowid"])
    d = None if dense is None else dense.select("sub", "rowid", F.col("score").alias("dense"))
    rows = rows.withColumn("dense", F.lit(None).cast("double")) if d is None else rows.join(d, ["sub", "rowid"], "left")
    rows = source_groups(relevance_floor(rows, backend).join(meta.select("rowid", "source"), "rowid"), pairs or {})
    return lost_in_middle(diversity_cap(rows, keep))
