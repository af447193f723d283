"""Retrieval quality: metrics, confidence, floor calibration, ablation, gold-set checks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import numeric


def ranking_metrics(ranked: DataFrame, gold: DataFrame, ks: tuple[int, ...] = (10, 20, 50), ndcg_at: int = 10) -> DataFrame:
    """(qid, n_relevant, n_results, recall_k..., ndcg, mrr, precision) of each query of gold (qid, rowid) with relevant rows.

    ranked: (qid, rowid, rank) in order of score, not as shown.  Relevance is binary.
    """
    n_rel = gold.groupBy("qid").agg(F.countDistinct("rowid").alias("n_relevant"))
    hits = ranked.join(gold.select("qid", "rowid", F.lit(1).alias("rel")).distinct(), ["qid", "rowid"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))
    near = F.col("rank") <= ndcg_at
    agg = hits.groupBy("qid").agg(
        F.count("*").alias("n_results"), *[F.sum(F.when(F.col("rank") <= k, F.col("rel")).otherwise(0)).alias(f"h_{k}") for k in ks],
        F.sum(F.when(near, F.col("rel") / F.log2(F.col("rank") + 1.0)).otherwise(0.0)).alias("dcg"), F.min(F.when(F.col("rel") == 1, F.col("rank"))).alias("first"), F.sum("rel").alias("found"),
    )
    rows = n_rel.join(agg, "qid", "left").fillna(0, ["n_results", "dcg", "found", *[f"h_{k}" for k in ks]])
    return rows.select(
        "qid", "n_relevant", "n_results", *[(F.col(f"h_{k}") / F.col("n_relevant")).alias(f"recall_{k}") for k in ks],
        (F.col("dcg") / numeric.ideal_dcg(F.least("n_relevant", F.lit(ndcg_at)))).alias("ndcg"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.try_divide("found", "n_results"), F.lit(0.0)).alias("precision"),
    )


def empty_accuracy(queries: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row: of queries that expect nothing, how many got nothing and how many leaked."""
    n = ranked.groupBy("qid").agg(F.count("*").alias("k"))
    rows = queries.filter("expected_empty").join(n, "qid", "left")
    return rows.agg(F.count("*").alias("negatives"), F.count_if(F.col("k").isNull()).alias("right"), F.count_if(F.col("k") > 0).alias("leaks"))


def _poisson(ids: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """(rows, samples) numbers of times that each row stands in each resample: Poisson(1) by a hash of row and resample."""
    u = np.uint64
    x = (ids.astype(u) * u(0x9E3779B97F4A7C15))[:, None] ^ (np.arange(1, samples + 1, dtype=u) * u(0xC2B2AE3D27D4EB4F) + u(seed))[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> u(shift))) * u(factor)
    uniform = ((x ^ (x >> u(31))) >> u(12)).astype(float) / float(1 << 52)
    # Chances of 0, at most 1, at most 2 ...
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
    return np.searchsorted(below, uniform, side="right")


def bootstrap_ci(values: DataFrame, value: str = "value", samples: int = 2000, ci: float = 0.95, seed: int = 11, fan: int = 64) -> DataFrame:
    """One row (mean, lo, hi): percentiles of the means of resamples; nulls without any value.

    A resample weighs rows by Poisson(1).  Each task adds up the weighted values of all resamples as two vectors, and returns
    one row; rows merge `fan` at a time, so what is shuffled is a row a partition, whatever the number of values.
    """
    rows = values.select(F.col(value).cast("double").alias("v"), F.monotonically_increasing_id().alias("i")).filter("v is not null")
    shape = "n long, total double, w array<double>, wv array<double>"

    def row(n: int, total: float, w: np.ndarray, wv: np.ndarray) -> pa.RecordBatch:
        kind = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total]), pa.array([w.tolist()], kind), pa.array([wv.tolist()], kind)], ["n", "total", "w", "wv"])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, w, wv = 0, 0.0, np.zeros(samples), np.zeros(samples)
        step = max(1, (1 << 21) // samples)
        for batch in batches:
            v, i = (c.to_numpy() for c in batch.columns)
            n, total = n + len(v), total + float(v.sum())
            for lo in range(0, len(v), step):
                times = _poisson(i[lo : lo + step], samples, seed)
                w += times.sum(0)
                wv += v[lo : lo + step] @ times
        if n:
            yield row(n, total, w, wv)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, w, wv = 0, 0.0, np.zeros(samples), np.zeros(samples)
        for batch in batches:
            for k in range(batch.num_rows):
                n, total = n + batch.column(0)[k].as_py(), total + batch.column(1)[k].as_py()
                w += np.asarray(batch.column(2)[k].values)
                wv += np.asarray(batch.column(3)[k].values)
        if n:
            yield row(n, total, w, wv)

    parts = rows.rdd.getNumPartitions()
    out = rows.mapInArrow(weighed, shape)
    while parts > 1:
        parts = -(-parts // fan)
        out = out.repartition(parts).mapInArrow(merged, shape)
    means = F.zip_with("wv", "w", lambda a, b: a / F.nullif(b, F.lit(0.0)))
    tail = (1 - ci) / 2
    each = out.select((F.col("total") / F.col("n")).alias("mean"), F.explode(means).alias("m"))
    return each.agg(F.first("mean").alias("mean"), F.percentile("m", F.lit(tail)).alias("lo"), F.percentile("m", F.lit(1 - tail)).alias("hi"))


def floor_sweep(scored: DataFrame, floors: DataFrame, margin: float, keep: int, beta: float = 0.5) -> DataFrame:
    """(floor, tp, fp, fn, leaks, empty_ok, precision, recall, f): quality at each floor.

    scored: (qid, rowid, score, relevant, expected_empty, n_relevant), with every query at least once (rowid null if
    it has no rows), before any floor.
    """
    rows = scored.crossJoin(F.broadcast(floors.select("floor")))
    top = F.max("score").over(W.partitionBy("floor", "qid"))
    ok = F.col("rowid").isNotNull() & (F.col("score") >= F.greatest("floor", F.col("_top") - margin))
    rows = rows.withColumn("_top", top).withColumn("_ok", F.coalesce(ok, F.lit(False)))
    rank = F.row_number().over(W.partitionBy("floor", "qid").orderBy(F.desc("_ok"), F.desc("score"), "rowid"))
    rows = rows.withColumn("_in", F.col("_ok") & (rank <= keep))
    per_q = rows.groupBy("floor", "qid").agg(F.max("expected_empty").alias("e"), F.max("n_relevant").alias("n"), F.count_if("_in").alias("k"), F.count_if(F.col("_in") & F.col("relevant")).alias("tp"))
    agg = per_q.groupBy("floor").agg(
        F.sum(F.when(~F.col("e"), F.col("tp")).otherwise(0)).alias("tp"), F.sum(F.when(~F.col("e"), F.col("k") - F.col("tp")).otherwise(0)).alias("fp"),
        F.sum(F.when(~F.col("e"), F.col("n") - F.col("tp")).otherwise(0)).alias("fn"), F.count_if(F.col("e") & (F.col("k") > 0)).alias("leaks"), F.count_if(F.col("e") & (F.col("k") == 0)).alias("empty_ok"),
    )
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return agg.withColumn("precision", p).withColumn("recall", r).withColumn("f", numeric.f_beta(F.col("precision"), F.col("recall"), beta))


def best_floor(sweep: DataFrame, slack: float = 0.01) -> DataFrame:
    """The middle floor of those within slack of the best."""
    near = sweep.crossJoin(F.broadcast(sweep.agg(F.max("f").alias("_best")))).filter(F.col("f") >= F.col("_best") - slack)
    return near.agg(F.array_sort(F.collect_list("floor")).alias("p")).select(F.get("p", F.floor(F.size("p") / 2).cast("int")).alias("floor"))


def ablation_deltas(results: DataFrame, metrics: list[str]) -> DataFrame:
    """results (ord, variant, metrics...) with the change of each metric from the variant before."""
    w = W.orderBy("ord")
    return results.select("*", *[(F.col(m) - F.lag(m).over(w)).alias(f"d_{m}") for m in metrics])


def kill_criteria(results: DataFrame, rules: DataFrame) -> DataFrame:
    """(variant, base, metric, gain, verdict) of rules (variant, base, metric, threshold); results: (variant, metric, value)."""
    v, b = results.select("variant", "metric", F.col("value").alias("v")), results.select(F.col("variant").alias("base"), "metric", F.col("value").alias("b"))
    rows = rules.join(v, ["variant", "metric"], "left").join(b, ["base", "metric"], "left").withColumn("gain", F.col("v") - F.col("b"))
    verdict = F.when(F.col("gain").isNull(), "MISSING").when((F.col("metric") == "empty_accuracy") & (F.col("gain") < 0), "REGRESSION").when(F.col("gain") >= F.col("threshold"), "KEEP").otherwise("KILL")
    return rows.select("variant", "base", "metric", "gain", verdict.alias("verdict"))


def goldset_status(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("total"), F.count_if("verified").alias("verified"), F.coalesce(F.avg(F.col("verified").cast("int")), F.lit(0.0)).alias("fraction"), F.count_if("expected_empty").alias("negatives"))


def goldset_problems(items: DataFrame, min_negatives: int = 8) -> DataFrame:
    """(id, problem): what is wrong with a gold set; an id of null is about the whole."""
    q = F.lower(F.trim(F.coalesce("question", F.lit(""))))
    rows = items.withColumn("_q", q).withColumn("_n", F.count("*").over(W.partitionBy("_q")))
    n_rel = F.size(F.coalesce("relevant_chunks", F.array().cast("array<bigint>")))
    found = F.array_compact(F.array(
        F.when(F.col("_q") == "", F.lit("empty question")), F.when((F.col("_q") != "") & (F.col("_n") > 1), F.lit("duplicate question")),
        F.when(F.col("expected_empty") & (n_rel > 0), F.lit("expects nothing but has relevant rows")), F.when(~F.col("expected_empty") & (n_rel == 0), F.lit("has no relevant rows")),
    ))
    few = items.agg(F.count_if("expected_empty").alias("k")).filter(F.col("k") < min_negatives).select(F.lit(None).cast("string").alias("id"), F.lit("too few negatives").alias("problem"))
    return rows.select(F.col("id").cast("string").alias("id"), F.explode(found).alias("problem")).union(few)


def round_robin(rows: DataFrame, by: str, n: int, seed: int, id_col: str) -> DataFrame:
    """n rows taken from the groups in turn, by a hash within each."""
    r = F.row_number().over(W.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), id_col), id_col))
    return rows.withColumn("_r", r).orderBy("_r", by).limit(n).drop("_r")


def metric_rollup(per_query: DataFrame, metrics: list[str]) -> DataFrame:
    return per_query.agg(*[F.avg(m).alias(m) for m in metrics], F.count("*").alias("n"))


def next_gold_ids(new: DataFrame, items: DataFrame, order: str = "question") -> DataFrame:
    """new items with ids G-001, G-002 and so on, after the largest that items have."""
    k = F.expr("try_cast(regexp_extract(id, '^G-([0-9]+)$', 1) as int)")
    top = items.agg(F.coalesce(F.max(k), F.lit(0)).alias("top"))
    number = (F.col("top") + F.row_number().over(W.orderBy(order))).cast("string")
    rows = new.crossJoin(top)  # one row
    return rows.withColumn("id", F.concat(F.lit("G-"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))).drop("top")


def sweep(base: dict, variants: dict[str, dict], run: Callable[[dict], DataFrame]) -> DataFrame:
    """The results of run(settings) for each variant, a patch of the base settings, with variant, ord and description.

    Settings are made anew for each variant; no variant sees another's.
    """
    from ..config import overlay

    parts = []
    for i, (name, patch) in enumerate(variants.items()):
        cfg = overlay(base, {k: v for k, v in patch.items() if not k.startswith("_")})
        parts.append(run(cfg).select(F.lit(i).alias("ord"), F.lit(name).alias("variant"), F.lit(patch.get("_desc", "")).alias("description"), "*"))
    return reduce(DataFrame.unionByName, parts)


def stamped(results: DataFrame, label: str, config_hash: str, kb_hash: str, reranker: str, verified: float) -> DataFrame:
    """results with where they come from."""
    values = {"label": label, "config_hash": config_hash, "kb_hash": kb_hash, "reranker": reranker, "verified": float(verified)}
    return results.withColumns({k: F.lit(v) for k, v in values.items()})
