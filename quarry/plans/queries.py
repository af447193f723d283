"""Each operator applied to the driver's tables, with the SQL that gives the same rows.

Stand-ins: documents are the chunks (doc_id is the row id), embeddings the dense matrix, labels the gate,
benchmark the queries, lineitem and events edges and claims.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from ..functions import numeric, text as tx
from ..operators import claims as cl, cleaning, coherence, dense, entities as en, evaluation as ev, grounding as gr, labels as lb, retrieval as rt, runs, upserts
from ..session import shared_dir
from .registry import query


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "rowid")


# ---- index and BM25 -----------------------------------------------------------------------------

TOK = r"tok AS (SELECT doc_id AS rowid, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS token FROM documents)"
BM25 = TOK + r""",
tf AS (SELECT rowid, token, count(*) AS f FROM tok GROUP BY ALL),
len AS (SELECT doc_id AS rowid, len(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS n FROM documents),
st AS (SELECT count(*) AS n_docs, avg(n) AS avg_len FROM len),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY ALL),
q AS (SELECT DISTINCT qid, token FROM (SELECT item_id AS qid, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS token FROM benchmark) WHERE length(token) > 1),
sc AS (SELECT qid, rowid, round(sum(CASE WHEN ln((n_docs - df + 0.5) / (df + 0.5)) > 0 THEN ln((n_docs - df + 0.5) / (df + 0.5)) ELSE 1e-6 END
         * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / avg_len))), 5) AS score
       FROM q JOIN tf USING (token) JOIN df USING (token) JOIN len USING (rowid) CROSS JOIN st GROUP BY ALL)"""


def _bm25(spark, sf_dir, allowed: DataFrame | None = None) -> DataFrame:
    docs = documents(spark, sf_dir)
    streams = {"raw": tx.tokens(F.col("text"))}
    terms = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.explode(F.array_distinct(F.filter(tx.tokens(F.col("text")), lambda x: F.length(x) > 1))).alias("term")).withColumn("stream", F.lit("raw"))
    scored = rt.bm25(rt.postings(docs, streams), rt.doc_lengths(docs, streams), terms)
    if allowed is not None:
        scored = scored.join(allowed, "rowid", "left_semi")
    return rt.top_k(scored.withColumn("score", F.round("score", 5)), 10).select("qid", "rowid", "rank", "score")


@query(f"WITH {BM25} SELECT qid, rowid, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM sc) WHERE rank <= 10")
def bm25_topk(spark, sf_dir):
    return _bm25(spark, sf_dir)


@query(f"""WITH {BM25}, ok AS (SELECT d.doc_id AS rowid FROM documents d LEFT JOIN labels l USING (doc_id) WHERE source NOT IN ('src3') AND (quality IS NULL OR quality = 1))
SELECT qid, rowid, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM sc SEMI JOIN ok USING (rowid)) WHERE rank <= 10""")
def filtered_bm25(spark, sf_dir):
    labels = t(spark, sf_dir, "labels").select(F.col("doc_id").alias("chunk_id"), (F.col("quality") == 1).alias("retrievable"))
    return _bm25(spark, sf_dir, rt.allowed_rows(documents(spark, sf_dir), None, labels, exclude_source=["src3"]))


@query(f"WITH {TOK} SELECT token, count(DISTINCT rowid) AS df, count(*) AS n FROM tok GROUP BY token")
def token_frequency(spark, sf_dir):
    p = rt.postings(documents(spark, sf_dir), {"raw": tx.tokens(F.col("text"))})
    return p.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))


# ---- dense ranking and fusion -------------------------------------------------------------------

COS = "WITH s AS (SELECT q.vec_id AS qid, r.vec_id AS rowid, r.label, q.label AS q_label, round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings r WHERE q.vec_id % 100 = 0{where})"


def _dense(spark, sf_dir, allowed: DataFrame | None = None, k: int = 10) -> DataFrame:
    vec = t(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "rowid")
    queries = vec.filter("rowid % 100 = 0").select(F.col("rowid").alias("qid"), "embedding")
    return dense.top_k(queries, vec, k, allowed, digits=6)


@query(COS.format(where="") + " SELECT qid, rowid, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM s) WHERE rank <= 10")
def dense_topk(spark, sf_dir):
    return _dense(spark, sf_dir).select("qid", "rowid", "rank", "score")


@query(COS.format(where=" AND r.label % 2 = 0") + " SELECT qid, rowid, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM s) WHERE rank <= 10")
def dense_topk_masked(spark, sf_dir):
    return _dense(spark, sf_dir, t(spark, sf_dir, "embeddings").filter("label % 2 = 0").select(F.col("vec_id").alias("rowid"))).select("qid", "rowid", "rank", "score")


CHANNELS = """ch AS (
  SELECT label AS sub, vec_id AS rowid, row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) AS r_dense,
         row_number() OVER (PARTITION BY label ORDER BY embedding[2] DESC, vec_id) AS r_sparse FROM embeddings),
en AS (SELECT label AS sub, vec_id AS rowid, row_number() OVER (PARTITION BY label ORDER BY embedding[3] DESC, vec_id) AS r_ent FROM embeddings WHERE embedding[3] > 0),
fused AS (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY rrf DESC, rowid) AS rank FROM (
  SELECT sub, rowid, r_ent, round(1.0 / (60 + r_dense) + coalesce(0.5 / (60 + r_ent), 0) + 0.8 / (60 + r_sparse), 12) AS rrf FROM ch LEFT JOIN en USING (sub, rowid))),
top AS (SELECT * FROM fused WHERE rank <= 48)"""
CHANNEL_WEIGHTS = {"dense": 1.0, "entity": 0.5, "sparse": 0.8, "off": 0.0}


def _channels(spark, sf_dir) -> DataFrame:
    vec = t(spark, sf_dir, "embeddings").select(F.col("label").alias("sub"), F.col("vec_id").alias("rowid"), "embedding")

    def one(name, i, rows):
        rank = F.row_number().over(W.partitionBy("sub").orderBy(F.desc(F.col("embedding")[i]), "rowid"))
        return rows.select("sub", F.lit(name).alias("channel"), F.lit(0).alias("query_ord"), "rowid", rank.alias("rank"))

    return one("dense", 0, vec).union(one("sparse", 1, vec)).union(one("entity", 2, vec.filter(F.col("embedding")[2] > 0))).union(one("off", 3, vec))


def _fused(spark, sf_dir) -> DataFrame:
    flat = rt.flatten_channel(_channels(spark, sf_dir))
    fused = rt.rrf(flat, CHANNEL_WEIGHTS, limit=1 << 30).withColumn("rrf", F.round("rrf", 12)).drop("rank")
    return rt.top_k(fused, rt.RRF_LIMIT, by="sub", score="rrf")


@query(f"WITH {CHANNELS} SELECT sub, rowid, rrf, rank, CASE WHEN r_ent IS NULL THEN 2 ELSE 3 END AS n_channels FROM top")
def rrf_fusion(spark, sf_dir):
    return _fused(spark, sf_dir).select("sub", "rowid", "rrf", "rank", F.size("channels").alias("n_channels"))


@query(f"""WITH {CHANNELS}, x AS (SELECT unnest(CASE WHEN r_ent IS NULL THEN ['dense', 'sparse'] ELSE ['dense', 'entity', 'sparse'] END) AS channel FROM top WHERE rank <= 10)
SELECT channel, count(*) AS present, CAST(0 AS BIGINT) AS alone FROM x GROUP BY channel""")
def channel_report(spark, sf_dir):
    return rt.channel_report(_fused(spark, sf_dir))


RANKED = "sc AS (SELECT label AS sub, vec_id AS rowid, 'g' || (vec_id % 7) AS source, embedding[1]::DOUBLE AS score, CASE WHEN vec_id % 3 = 0 THEN NULL ELSE embedding[2]::DOUBLE + 0.7 END AS dense FROM embeddings)"


def _scored(spark, sf_dir) -> DataFrame:
    e = t(spark, sf_dir, "embeddings")
    return e.select(
        F.col("label").alias("sub"), F.col("vec_id").alias("rowid"), F.concat(F.lit("g"), (F.col("vec_id") % 7).cast("string")).alias("source"), F.col("embedding")[0].cast("double").alias("score"),
        F.when(F.col("vec_id") % 3 == 0, None).otherwise(F.col("embedding")[1].cast("double") + 0.7).alias("dense"),
    )


@query(f"WITH {RANKED}, f AS (SELECT *, greatest(0.2, max(score) OVER (PARTITION BY sub) - 0.45) AS floor FROM sc) SELECT sub, rowid, score, floor FROM f WHERE score >= floor")
def rerank_floor(spark, sf_dir):
    return rt.relevance_floor(_scored(spark, sf_dir), "hosted").select("sub", "rowid", "score", "floor")


@query(f"WITH {RANKED}, f AS (SELECT *, max(score) OVER (PARTITION BY sub) - 0.25 AS floor FROM sc WHERE dense IS NULL OR dense >= 0.76) SELECT sub, rowid, score, floor FROM f WHERE score >= floor")
def relative_floor(spark, sf_dir):
    return rt.relevance_floor(_scored(spark, sf_dir), "llm").select("sub", "rowid", "score", "floor")


CAPPED = RANKED + """,
g AS (SELECT *, row_number() OVER (PARTITION BY sub, source ORDER BY score DESC, rowid) > 5 AS ov FROM sc),
p AS (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY ov, score DESC, rowid) AS pick FROM g),
kept AS (SELECT sub, rowid, source, score, row_number() OVER (PARTITION BY sub ORDER BY score DESC, rowid) - 1 AS pos, count(*) OVER (PARTITION BY sub) AS n FROM p WHERE pick <= 10)"""


def _capped(spark, sf_dir) -> DataFrame:
    return rt.diversity_cap(rt.source_groups(_scored(spark, sf_dir), {}), 10)


@query(f"WITH {CAPPED} SELECT sub, rowid, source, score, CAST(pos AS INTEGER) AS pos FROM kept")
def diversity_cap(spark, sf_dir):
    return _capped(spark, sf_dir).select("sub", "rowid", "source", "score", "pos")


@query(f"WITH {CAPPED} SELECT sub, rowid, CAST(CASE WHEN n < 4 THEN pos WHEN pos % 2 = 0 THEN pos // 2 ELSE n - 1 - (pos - 1) // 2 END AS INTEGER) AS shown FROM kept")
def lost_in_middle(spark, sf_dir):
    return rt.lost_in_middle(_capped(spark, sf_dir)).select("sub", "rowid", "shown")


@query(f"""WITH {CAPPED}, a AS (SELECT sub, count(*) AS n_kept, count(DISTINCT source) AS n_sources, max(score) AS top FROM kept WHERE score > 0.2 AND sub % 4 <> 0 GROUP BY sub),
subs AS (SELECT DISTINCT label AS sub FROM embeddings)
SELECT sub, coalesce(n_kept, 0) AS n_kept, coalesce(n_sources, 0) AS n_sources, top,
  CASE WHEN coalesce(n_kept, 0) = 0 THEN 'GAP' WHEN n_kept < 3 THEN 'THIN' WHEN top < 0.35 THEN 'THIN' WHEN n_sources = 1 THEN 'SINGLE-SOURCE' ELSE 'OK' END AS status FROM subs LEFT JOIN a USING (sub)""")
def pack_status(spark, sf_dir):
    kept = _capped(spark, sf_dir).filter("score > 0.2 and sub % 4 <> 0")
    return rt.pack_status(t(spark, sf_dir, "embeddings").select(F.col("label").alias("sub")).distinct(), kept, True)


@query(f"""WITH {CHANNELS}, fl AS (SELECT *, 1.0 - (row_number() OVER (PARTITION BY sub ORDER BY rank) - 1) / CAST(count(*) OVER (PARTITION BY sub) AS DOUBLE) AS score FROM top),
ok AS (SELECT *, 'g' || (rowid % 7) AS source FROM (SELECT *, max(score) OVER (PARTITION BY sub) - 0.15 AS floor FROM fl) WHERE score >= floor),
g AS (SELECT *, row_number() OVER (PARTITION BY sub, source ORDER BY score DESC, rowid) > 5 AS ov FROM ok),
p AS (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY ov, score DESC, rowid) AS pick FROM g),
kept AS (SELECT sub, rowid, source, score, row_number() OVER (PARTITION BY sub ORDER BY score DESC, rowid) - 1 AS pos, count(*) OVER (PARTITION BY sub) AS n FROM p WHERE pick <= 10)
SELECT sub, rowid, source, round(score, 9) AS score, CAST(CASE WHEN n < 4 THEN pos WHEN pos % 2 = 0 THEN pos // 2 ELSE n - 1 - (pos - 1) // 2 END AS INTEGER) AS shown FROM kept""")
def retrieval_funnel(spark, sf_dir):
    meta = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rowid"), F.concat(F.lit("g"), (F.col("vec_id") % 7).cast("string")).alias("source"))
    return rt.funnel(_channels(spark, sf_dir), meta, CHANNEL_WEIGHTS, "none").select("sub", "rowid", "source", F.round("score", 9).alias("score"), "shown")


# ---- evaluation ---------------------------------------------------------------------------------

METRICS = COS.format(where=" AND r.vec_id <> q.vec_id") + """,
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM s) WHERE rank <= 50),
g AS (SELECT q.vec_id AS qid, count(r.vec_id) AS n_relevant FROM embeddings q JOIN embeddings r ON q.label = r.label AND q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL),
a AS (SELECT qid, count(*) AS n_results, sum(CASE WHEN rank <= 10 AND label = q_label THEN 1 ELSE 0 END) AS h10, sum(CASE WHEN rank <= 20 AND label = q_label THEN 1 ELSE 0 END) AS h20,
  sum(CASE WHEN label = q_label THEN 1 ELSE 0 END) AS h50, sum(CASE WHEN rank <= 10 AND label = q_label THEN 1 / log2(rank + 1.0) ELSE 0 END) AS dcg, min(CASE WHEN label = q_label THEN rank END) AS first FROM r GROUP BY qid),
i AS (SELECT k, (SELECT sum(1 / log2(j + 1.0)) FROM range(1, k + 1) x(j)) AS ideal FROM range(1, 11) y(k))
SELECT qid, n_relevant, n_results, round(h10 / n_relevant, 9) AS recall_10, round(h20 / n_relevant, 9) AS recall_20, round(h50 / n_relevant, 9) AS recall_50,
  round(dcg / ideal, 9) AS ndcg, round(coalesce(1.0 / first, 0), 9) AS mrr, round(h50 / n_results, 9) AS precision
FROM g JOIN a USING (qid) JOIN i ON k = least(n_relevant, 10)"""


@query(METRICS)
def retrieval_metrics(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rowid"), "label", "embedding")
    queries = e.filter("rowid % 100 = 0").select(F.col("rowid").alias("qid"), "embedding")
    # A query finds itself too, so one row more is asked for, and ranks are counted without it.
    found = dense.top_k(queries, e, 51, digits=6).filter("qid <> rowid").drop("rank")
    gold = e.filter("rowid % 100 = 0").select(F.col("rowid").alias("qid"), "label").join(e.select("rowid", "label"), "label").filter("qid <> rowid").select("qid", "rowid")
    m = ev.ranking_metrics(rt.top_k(found, 50), gold)
    return m.select("qid", "n_relevant", "n_results", *[F.round(c, 9).alias(c) for c in ("recall_10", "recall_20", "recall_50", "ndcg", "mrr", "precision")])


SWEEP = """WITH sc AS (SELECT label AS qid, vec_id AS rowid, embedding[1]::DOUBLE AS score, embedding[2] > 0 AS relevant, label % 5 = 0 AS ex FROM embeddings),
n AS (SELECT qid, count(*) FILTER (relevant) AS n_rel FROM sc GROUP BY qid), fl AS (SELECT j / 20.0 AS floor FROM range(0, 12) x(j)),
x AS (SELECT *, max(score) OVER (PARTITION BY floor, qid) AS top FROM sc JOIN n USING (qid) CROSS JOIN fl),
y AS (SELECT *, score >= greatest(floor, top - 0.45) AS ok FROM x),
z AS (SELECT *, ok AND row_number() OVER (PARTITION BY floor, qid ORDER BY ok DESC, score DESC, rowid) <= 10 AS inn FROM y),
q AS (SELECT floor, qid, bool_or(ex) AS ex, max(n_rel) AS n, count(*) FILTER (inn) AS k, count(*) FILTER (inn AND relevant) AS tp FROM z GROUP BY ALL),
a AS (SELECT floor, CAST(sum(CASE WHEN ex THEN 0 ELSE tp END) AS BIGINT) AS tp, CAST(sum(CASE WHEN ex THEN 0 ELSE k - tp END) AS BIGINT) AS fp, CAST(sum(CASE WHEN ex THEN 0 ELSE n - tp END) AS BIGINT) AS fn,
  count(*) FILTER (ex AND k > 0) AS leaks, count(*) FILTER (ex AND k = 0) AS empty_ok FROM q GROUP BY floor),
w AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM a),
v AS (SELECT *, CASE WHEN 0.25 * p + r > 0 THEN p * r * 1.25 / (0.25 * p + r) ELSE 0 END AS f FROM w)
"""


def _sweep(spark, sf_dir) -> DataFrame:
    e = t(spark, sf_dir, "embeddings")
    sc = e.select(F.col("label").alias("qid"), F.col("vec_id").alias("rowid"), F.col("embedding")[0].cast("double").alias("score"), (F.col("embedding")[1] > 0).alias("relevant"), (F.col("label") % 5 == 0).alias("expected_empty"))
    sc = sc.withColumn("n_relevant", F.count_if("relevant").over(W.partitionBy("qid")))
    return ev.floor_sweep(sc, spark.range(12).select((F.col("id") / 20).alias("floor")), 0.45, 10)


@query(SWEEP + "SELECT floor, tp, fp, fn, leaks, empty_ok, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f FROM v")
def floor_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir).select("floor", "tp", "fp", "fn", "leaks", "empty_ok", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f")])


@query(SWEEP + "SELECT list_sort(list(floor))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS floor FROM v WHERE round(f, 9) >= (SELECT max(round(f, 9)) FROM v) - 0.01")
def best_floor(spark, sf_dir):
    return ev.best_floor(_sweep(spark, sf_dir).withColumn("f", F.round("f", 9)))


@query("""WITH r AS (SELECT event_type AS variant, dense_rank() OVER (ORDER BY event_type) AS ord, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY event_type)
SELECT ord, variant, mean, n, round(mean - lag(mean) OVER (ORDER BY ord), 6) AS d_mean, n - lag(n) OVER (ORDER BY ord) AS d_n FROM r""")
def ablation_delta(spark, sf_dir):
    r = t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("variant")).agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"))
    r = r.withColumn("ord", F.dense_rank().over(W.orderBy("variant"))).select("ord", "variant", "mean", "n")
    return ev.ablation_deltas(r, ["mean", "n"]).withColumn("d_mean", F.round("d_mean", 6))


@query("""WITH v AS (SELECT event_type AS variant, count(*) AS value FROM events GROUP BY event_type), b AS (SELECT * FROM v ORDER BY variant LIMIT 1)
SELECT v.variant, b.variant AS base, 'n' AS metric, CAST(v.value - b.value AS DOUBLE) AS gain, CASE WHEN v.value - b.value >= 0 THEN 'KEEP' ELSE 'KILL' END AS verdict FROM v, b""")
def kill_criteria(spark, sf_dir):
    v = t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("variant")).agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("n"))
    rules = v.select("variant", "metric", F.lit(0.0).alias("threshold")).crossJoin(v.agg(F.min("variant").alias("base")))
    return ev.kill_criteria(v, rules)


@query("SELECT count(*) AS total, count(*) FILTER (toxic = 0) AS verified, avg(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS fraction, count(*) FILTER (quality = 0) AS negatives FROM labels")
def goldset_status(spark, sf_dir):
    return ev.goldset_status(t(spark, sf_dir, "labels").select((F.col("toxic") == 0).alias("verified"), (F.col("quality") == 0).alias("expected_empty")))


@query("""WITH i AS (SELECT CAST(conv_id AS VARCHAR) || ':' || turn AS id, lower(trim(coalesce(text, ''))) AS q, role = 'assistant' AS e, turn % 3 AS k FROM conversations),
n AS (SELECT *, count(*) OVER (PARTITION BY q) AS c FROM i)
SELECT id, problem FROM (SELECT id, unnest([CASE WHEN q = '' THEN 'empty question' END, CASE WHEN q <> '' AND c > 1 THEN 'duplicate question' END,
  CASE WHEN e AND k > 0 THEN 'expects nothing but has relevant rows' END, CASE WHEN NOT e AND k = 0 THEN 'has no relevant rows' END]) AS problem FROM n) WHERE problem IS NOT NULL
UNION ALL SELECT NULL, 'too few negatives' FROM (SELECT count(*) FILTER (e) AS k FROM i) WHERE k < 8""")
def goldset_problems(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    rel = F.expr("slice(array(1L, 2L), 1, cast(turn % 3 as int))")
    return ev.goldset_problems(c.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("question"), (F.col("role") == "assistant").alias("expected_empty"), rel.alias("relevant_chunks")))


@query(None)
def bootstrap_ci(spark, sf_dir):
    return ev.bootstrap_ci(t(spark, sf_dir, "labels").withColumn("value", F.col("quality")), samples=200)


# ---- labels -------------------------------------------------------------------------------------

_LINES = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') <> '')"


def _share(pattern: str, least: int, part: float) -> str:
    p = pattern.replace("'", "''")
    return f"len(list_filter(ls, lambda x: regexp_matches(x, '{p}'))) >= greatest({least}, n * {part})"


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


LABELS = rf"""base AS (SELECT doc_id AS chunk_id, source, coalesce(text, '') AS text, {_LINES} AS ls FROM documents),
b2 AS (SELECT *, len(ls) AS n, coalesce(ls[1], '') AS first, lower(chr(10) || coalesce(ls[1], '')) AS head,
  len(list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: len(regexp_split_to_array(trim(s, ' '), '\s+')) >= 18 AND NOT regexp_matches(ltrim(s, ' '), '^[|*-]'))) >= 2 AS prose FROM base),
lab AS (SELECT chunk_id, source, text, CASE WHEN n = 0 THEN 'image'
  WHEN regexp_matches(text, '{_sql(lb.TOC)}') OR regexp_matches(head, '{_sql(lb.TOC_HEAD)}') THEN 'toc'
  WHEN NOT prose AND {_share(lb.INDEX_ROW, 3, 0.5)} THEN 'index'
  WHEN NOT prose AND ({_share(lb.BIBLIOGRAPHY, 5, 0.8)} OR regexp_matches(head, '{_sql(lb.BIBLIOGRAPHY_HEAD)}')) THEN 'bibliography'
  WHEN {_share(lb.TABLE_ROW, 2, 0.5)} THEN 'table' WHEN {_share(lb.LIST_ROW, 3, 0.6)} THEN 'list'
  WHEN regexp_matches(first, '{_sql(lb.CAPTION)}') AND n <= 2 AND length(text) < 300 THEN 'caption'
  WHEN n >= 3 AND {_share(lb.FOOTNOTE, 3, 0.6)} THEN 'footnote'
  WHEN regexp_matches(text, '{_sql(lb.FORMULA)}') AND length(text) < 600 THEN 'formula' ELSE 'text' END AS structural FROM b2)"""
QUALITY = LABELS + rf""",
m AS (SELECT *, len(regexp_extract_all(text, '{_sql(tx.WORD)}')) AS nw, coalesce(list_max(list_transform(regexp_extract_all(text, '{_sql(tx.WORD)}'), lambda x: length(x))), 0) AS longest,
  len(regexp_extract_all(text, '[A-Za-zÀ-ɏḀ-ỿऀ-ॿ]')) AS letters, len(regexp_extract_all(text, '{_sql(lb.GARBLE)}')) AS garble,
  len(regexp_extract_all(text, '\p{{Nd}}')) / greatest(length(text), 1) AS digits, structural IN ('table', 'formula') AS fr FROM lab),
d AS (SELECT *, CASE WHEN fr THEN 0.0 WHEN nw = 0 THEN 1.0 WHEN letters < 20 THEN 0.9
  ELSE round(least(1.0, least(1.0, garble / greatest(letters, 1) / 0.08) * 0.35::DOUBLE + CASE WHEN longest > 32 THEN 0.2::DOUBLE ELSE 0 END), 3) END AS damage FROM m),
r AS (SELECT *, damage > 0.6 AS i1, damage > 0.35 AND damage <= 0.6 AS i2, structural IN ('toc', 'index', 'bibliography', 'header', 'footer', 'image', 'page_number') AS i3,
  nw < 40 AND NOT fr AS i4, digits > 0.25 AND NOT fr AS i5, regexp_matches(trim(text, ' '), '^\p{{Ll}}') AND NOT regexp_matches(trim(text, ' '), '[.!?"”)\]]$') AS i6 FROM d),
ql AS (SELECT chunk_id, source, structural, length(text) AS chars, CAST(damage AS DOUBLE) AS damage, i1, i2, i3, i4, i5, i6, nw,
  round(greatest(0, least(1, 1.0::DOUBLE - (CASE WHEN i1 THEN 0.5 ELSE 0 END::DOUBLE + CASE WHEN i2 THEN 0.2 ELSE 0 END::DOUBLE + CASE WHEN i3 THEN 0.6 ELSE 0 END::DOUBLE
    + CASE WHEN i4 THEN 0.25 ELSE 0 END::DOUBLE + CASE WHEN i5 THEN 0.3 ELSE 0 END::DOUBLE + CASE WHEN i6 THEN 0.1 ELSE 0 END::DOUBLE))), 3) AS quality FROM r)"""


def _labelled(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.withColumn("structural", lb.structural_label(F.col("text"), F.lit("")))
    return lb.quality(rows).withColumnRenamed("rowid", "chunk_id").withColumn("chars", F.length(F.coalesce("text", F.lit(""))))


@query(f"WITH {LABELS} SELECT chunk_id, structural FROM lab")
def structural_labels(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("rowid").alias("chunk_id"), lb.structural_label(F.col("text"), F.lit("")).alias("structural"))


def _parity(spark, sf_dir) -> DataFrame:
    """Quality by the rule whose word pattern has no one-letter words, so that SQL without look-around can follow."""
    docs = documents(spark, sf_dir).withColumn("structural", lb.structural_label(F.col("text"), F.lit("")))
    rows = lb.quality(docs, count_singles=False)
    return rows.withColumn("chars", F.length(F.coalesce("text", F.lit(""))))


@query(f"""WITH {QUALITY} SELECT chunk_id, structural, damage, quality, NOT i3 AND quality >= 0.45 AS retrievable FROM ql""")
def quality_issues(spark, sf_dir):
    rows = _parity(spark, sf_dir)
    return rows.select(F.col("rowid").alias("chunk_id"), "structural", "damage", "quality", rt.is_retrievable(F.col("quality"), F.col("issues")).alias("retrievable"))


@query(f"""WITH {QUALITY} SELECT 'structural' AS part, structural AS value, count(*) AS n FROM ql GROUP BY ALL
UNION ALL SELECT 'issue', v, count(*) FROM (SELECT unnest([CASE WHEN i1 THEN 'ocr-damage' END, CASE WHEN i2 THEN 'ocr-noise' END, CASE WHEN i3 THEN 'non-evidential' END,
  CASE WHEN i4 THEN 'short' END, CASE WHEN i5 THEN 'numeric-fragment' END, CASE WHEN i6 THEN 'fragment' END]) AS v FROM ql) WHERE v IS NOT NULL GROUP BY ALL""")
def label_report(spark, sf_dir):
    return lb.summary(_parity(spark, sf_dir))


@query(f"WITH {QUALITY} SELECT CAST(least(floor(quality * 5), 4) AS INTEGER) AS bucket, count(*) AS n, avg(chars) AS avg_chars FROM ql GROUP BY ALL")
def quality_hist(spark, sf_dir):
    return lb.quality_histogram(_parity(spark, sf_dir))


@query(None)
def exclusion_reasons(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return lb.exclusions(rows.withColumn("retrievable", rt.is_retrievable(F.col("quality"), F.col("issues"))))


@query("""SELECT label, judged, n, sum(CASE WHEN label = judged THEN n ELSE 0 END) OVER (PARTITION BY label) / sum(n) OVER (PARTITION BY label) AS precision
FROM (SELECT quality AS label, toxic AS judged, count(*) AS n FROM labels GROUP BY ALL)""")
def label_confusion(spark, sf_dir):
    return lb.confusion(t(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("judged")))


SHINGLES = rf"""w AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{_sql(tx.WORD)}'), lambda x: lower(x)) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 8], ' ') AS h FROM (SELECT doc_id, w, unnest(range(0, len(w) - 7, 2)) AS i FROM w WHERE len(w) >= 8)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY ALL),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL)
"""


@query("WITH " + SHINGLES + "SELECT a, b, c / (x.n + y.n - c) AS similarity FROM pr JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b WHERE c / (x.n + y.n - c) >= 0.75")
def near_dup_pairs(spark, sf_dir):
    return lb.near_duplicate_pairs(documents(spark, sf_dir))


@query(None)
def dup_demotion(spark, sf_dir):
    docs = documents(spark, sf_dir)
    shared_dir(spark)
    groups = lb.star_groups(lb.near_duplicate_pairs(docs).checkpoint())
    labels = lb.structural_pass(docs.withColumn("trail", F.lit("")), duplicate_of=lb.duplicates_of(groups, docs))
    return labels.filter(F.exists("issues", lambda x: x.startswith("duplicate-of"))).select("chunk_id", "retrievable", F.array_join("issues", ",").alias("issues"))


# ---- text and cleaning --------------------------------------------------------------------------

RUNNING = r"""WITH l AS (SELECT doc_id AS doc, regexp_replace(regexp_replace(x, '^[*_ ]+', ''), '[*_ ]+$', '') AS bare FROM (
  SELECT doc_id, CASE WHEN regexp_matches(x, '^(#{1,6})\s*(.*?)\s*#*$') THEN regexp_extract(x, '^(#{1,6})\s*(.*?)\s*#*$', 2) ELSE x END AS x FROM (
    SELECT doc_id, trim(unnest(string_split(coalesce(text, ''), chr(10))), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x FROM documents))),
m AS (SELECT doc, bare, length(regexp_replace(bare, '[^\p{L}]', '', 'g')) AS nl, length(regexp_replace(bare, '[^\p{Lu}]', '', 'g')) AS nu FROM l WHERE length(bare) BETWEEN 3 AND 70)
SELECT doc, bare, count(*) AS hits FROM m WHERE nl > 0 AND nu / nl >= 0.6 GROUP BY ALL HAVING count(*) >= 5"""


@query(RUNNING)
def clean_running_heads(spark, sf_dir):
    return cleaning.running_heads(cleaning.lines(t(spark, sf_dir, "documents")))


def _page_markdown(spark, sf_dir) -> DataFrame:
    """Pages as Markdown: headings as marks, blocks as paragraphs, other tags gone."""
    html = F.coalesce(F.col("html"), F.lit(""))
    s = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    for n in range(1, 7):
        s = F.regexp_replace(s, rf"(?i)<h{n}\b[^>]*>", f"\n\n{'#' * n} ")
    s = F.regexp_replace(s, r"(?i)</?(?:p|div|br|li|tr|table|ul|ol|section|article|h[1-6]|header|footer|nav|title|body|head)\b[^>]*>", "\n\n")
    return t(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.regexp_replace(s, r"<!--(?!\s*page)[\s\S]*?-->", " "), r"<[^>]*>", " ").alias("text"))


@query(None)
def clean_page_lines(spark, sf_dir):
    return cleaning.clean_lines(_page_markdown(spark, sf_dir), "page_id")


@query(None)
def heading_trail(spark, sf_dir):
    rows = cleaning.heading_trails(cleaning.clean_lines(_page_markdown(spark, sf_dir), "page_id"))
    return rows.filter("level > 0").select("doc", "pos", "level", "text", "trail")


@query(None)
def chunker(spark, sf_dir):
    return cleaning.chunks(t(spark, sf_dir, "documents"))


@query("""WITH p AS (SELECT DISTINCT l_suppkey AS grp, l_partkey AS page FROM lineitem), i AS (SELECT *, page - row_number() OVER (PARTITION BY grp ORDER BY page) AS island FROM p),
r AS (SELECT grp, min(page) AS lo, max(page) AS hi FROM i GROUP BY grp, island)
SELECT grp, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ', ' ORDER BY lo) AS ranges FROM r GROUP BY grp""")
def page_islands(spark, sf_dir):
    return cleaning.page_ranges(t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("page")), "grp")


def _fold_sql(x: str) -> str:
    s = f"regexp_replace(translate(lower(regexp_replace({x}, '[''’]s$|[''’]$', '', 'g')), '{tx.MARKED}', '{tx.PLAIN}'), '\\p{{M}}', '', 'g')"
    s = f"replace({s}, '''', '')"
    for a, b in tx.DIGRAPHS:
        s = f"replace({s}, '{a}', '{b}')"
    return f"regexp_replace(array_to_string(list_filter(string_split({s}, ''), lambda c, i: i = 1 OR c <> string_split({s}, '')[i - 1]), ''), '[^a-z0-9]', '', 'g')"


WORDS = rf"wd AS (SELECT rowid, word, count(*) AS n FROM (SELECT doc_id AS rowid, unnest(regexp_extract_all(coalesce(text, ''), '{_sql(tx.WORD)}')) AS word FROM documents) GROUP BY ALL), uw AS (SELECT word, {_fold_sql('word')} AS folded FROM (SELECT DISTINCT word FROM wd))"


@query(f"WITH {WORDS} SELECT folded AS token, CAST(sum(n) AS BIGINT) AS n FROM wd JOIN uw USING (word) WHERE folded <> '' GROUP BY folded")
def fold_tokens(spark, sf_dir):
    # Words are counted first, so each distinct one is folded once.
    words = documents(spark, sf_dir).select(F.explode(tx.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.groupBy(tx.fold(F.col("word")).alias("token")).agg(F.sum("n").alias("n")).filter("token <> ''")


@query(rf"SELECT doc_id, x AS numeral, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{_sql(tx.NUMERAL)}')) AS x FROM documents) GROUP BY ALL")
def numerals(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.explode(tx.numerals(F.col("text"))).alias("numeral")).groupBy("doc_id", "numeral").agg(F.count("*").alias("n"))


@query(None)
def proper_noun_freq(spark, sf_dir):
    return t(spark, sf_dir, "documents").select(F.explode(tx.proper_nouns(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, length(coalesce(text, '')) AS chars, len(regexp_extract_all(coalesce(text, ''), '[\x{0900}-\x{097F}]')) AS devanagari,
len(regexp_extract_all(coalesce(text, ''), '[āīūṛṝḷṃḥṅñṭḍṇśṣĀĪŪṚṬḌṆŚṢ]')) AS iast, len(regexp_extract_all(coalesce(text, ''), 'Ã|â€|�')) AS mojibake FROM documents""")
def text_health(spark, sf_dir):
    h = t(spark, sf_dir, "documents").select("doc_id", tx.text_health(F.col("text")).alias("h"))
    return h.select("doc_id", "h.chars", "h.devanagari", "h.iast", "h.mojibake")


# ---- entities -----------------------------------------------------------------------------------

REGISTRY = [
    ("E:PLACE:001", "Thea", "place", ["Thea", "The ea"], True), ("E:PLACE:002", "Onat", "place", ["Onati"], False), ("E:PERSON:001", "Erst", "person", ["Ersta", "Erest"], False),
    ("E:PERSON:002", "Der Schön", "person", ["der", "Der Sch"], False), ("E:WORK:001", "Que", "work", ["que la", "qué"], False), ("E:WORK:002", "Onati Er", "work", ["Onat er"], False),
    ("E:OTHER:001", "Of the", "other", ["of the"], False), ("E:OTHER:002", "Thea Er", "other", ["Thea", "Erst"], False),
]
REG_SQL = "reg(entity_id, alias) AS (VALUES " + ", ".join(f"('{e}', '{a}')" for e, c, _, al, _ in REGISTRY for a in dict.fromkeys([c, *al])) + f"), al AS (SELECT DISTINCT entity_id, {_fold_sql('alias')} AS folded, string_split(alias, ' ') AS parts FROM reg)"


def _registry(spark) -> DataFrame:
    return en.normalised_registry(spark.createDataFrame(REGISTRY, "entity_id string, canonical string, type string, aliases array<string>, curated boolean"))


MENTIONS = f"""{WORDS}, {REG_SQL},
one AS (SELECT entity_id, rowid AS chunk_id, sum(n) AS n FROM wd JOIN uw USING (word) JOIN (SELECT DISTINCT entity_id, folded FROM al WHERE len(parts) = 1) USING (folded) GROUP BY ALL),
fw AS (SELECT rowid, ' ' || array_to_string(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '{_sql(tx.WORD)}'), lambda w: {_fold_sql('w')}), lambda f: f <> ''), ' ') || ' ' AS stream FROM (SELECT doc_id AS rowid, text FROM documents)),
lw AS (SELECT DISTINCT entity_id, array_to_string(list_transform(parts, lambda w: {_fold_sql('w')}), ' ') AS words FROM al WHERE len(parts) > 1),
many AS (SELECT entity_id, rowid AS chunk_id, count(*) AS n FROM fw, lw WHERE contains(stream, ' ' || words || ' ') GROUP BY ALL),
men AS (SELECT entity_id, chunk_id, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM one UNION ALL SELECT * FROM many) GROUP BY ALL)"""


def _mentions(spark, sf_dir) -> DataFrame:
    return en.mentions(documents(spark, sf_dir), en.aliases(_registry(spark)))


@query(f"WITH {MENTIONS} SELECT entity_id, chunk_id, n FROM men")
def entity_mentions(spark, sf_dir):
    return _mentions(spark, sf_dir)


@query(f"""WITH {MENTIONS}, q(qid, entity_id) AS (VALUES (1, 'E:PLACE:001'), (1, 'E:PERSON:001'), (2, 'E:WORK:001'), (2, 'E:OTHER:001'), (2, 'E:PLACE:002')),
a AS (SELECT qid, chunk_id AS rowid, count(DISTINCT entity_id) AS ents, CAST(sum(n) AS BIGINT) AS hits FROM men JOIN q USING (entity_id) GROUP BY ALL)
SELECT qid, rowid, ents, hits, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY ents DESC, hits DESC, rowid) AS rank FROM a) WHERE rank <= 20""")
def entity_channel(spark, sf_dir):
    q = spark.createDataFrame([(1, "E:PLACE:001"), (1, "E:PERSON:001"), (2, "E:WORK:001"), (2, "E:OTHER:001"), (2, "E:PLACE:002")], "qid int, entity_id string")
    s = rt.entity_scores(q, _mentions(spark, sf_dir))
    rank = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("ents"), F.desc("hits"), "rowid"))
    return s.withColumn("rank", rank).filter("rank <= 20").select("qid", "rowid", "ents", "hits", "rank")


@query(f"""WITH al AS (SELECT 'E:PART:' || p_partkey AS entity_id, unnest([p_name, p_brand || ' ' || p_size]) AS alias FROM part), fo AS (SELECT entity_id, {_fold_sql('alias')} AS folded FROM al)
SELECT folded, array_to_string(list_sort(list(DISTINCT entity_id)), ',') AS ids FROM fo WHERE folded <> '' GROUP BY folded HAVING count(DISTINCT entity_id) > 1""")
def alias_collisions(spark, sf_dir):
    """Parts are entities; their names and their brands with a size are aliases."""
    other = F.array(F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")))
    parts = t(spark, sf_dir, "part").select(F.concat(F.lit("E:PART:"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("canonical"), F.lit("part").alias("type"), other.alias("aliases"), F.lit(True).alias("curated"))
    return en.collisions(en.aliases(en.normalised_registry(parts))).select("folded", F.array_join("ids", ",").alias("ids"))


@query(None)
def candidate_terms(spark, sf_dir):
    return en.candidate_terms(documents(spark, sf_dir), en.aliases(_registry(spark)))


@query(None)
def ungrounded_terms(spark, sf_dir):
    said = F.when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" It was in Zanzibar, in 1947."))).otherwise(F.col("text"))
    turns = t(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("sub"), "role", said.alias("text"))
    return gr.ungrounded(turns.filter("role = 'assistant'"), turns.filter("role = 'user'").select("sub", "text"), en.aliases(_registry(spark)))


# ---- packs, citations, verdicts -----------------------------------------------------------------

PACKS = """p AS (SELECT source AS n, lang AS sub, 'E' || row_number() OVER (PARTITION BY source ORDER BY doc_id) AS id, text, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 's' || doc_id % 5 END AS src, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 1 END AS pg, doc_id FROM documents),
nm AS (SELECT *, regexp_replace(lower(trim(coalesce(text, ''), ' ')), '\\s+', ' ', 'g') AS t FROM p),
dp AS (SELECT *, row_number() OVER (PARTITION BY n, t ORDER BY doc_id) AS nth, first_value(id) OVER (PARTITION BY n, t ORDER BY doc_id) AS f FROM nm),
ck AS (SELECT n, sub, id, src, CASE WHEN nth > 1 AND t <> '' THEN f END AS duplicate_of, CASE WHEN t = '' THEN 1 ELSE 0 END + CASE WHEN src IS NULL THEN 1 ELSE 0 END AS ne, CASE WHEN pg IS NULL THEN 1 ELSE 0 END + CASE WHEN nth > 1 AND t <> '' THEN 1 ELSE 0 END AS nw FROM dp)""".replace("\\\\", "\\")


def _checked(spark, sf_dir) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    rows = d.select(
        F.col("source").alias("n"), F.col("lang").alias("sub"), F.concat(F.lit("E"), F.row_number().over(W.partitionBy("source").orderBy("doc_id")).cast("string")).alias("id"), "text",
        F.when(F.col("doc_id") % 11 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))).alias("source"), F.when(F.col("doc_id") % 4 == 0, None).otherwise(1).alias("page_start"),
    )
    return gr.validate_passages(rows)


@query(f"WITH {PACKS} SELECT n, sub, id, duplicate_of, ne AS n_errors, nw AS n_warnings FROM ck")
def pack_validation(spark, sf_dir):
    return _checked(spark, sf_dir).select("n", "sub", "id", "duplicate_of", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"))


@query(f"""WITH {PACKS}, subs AS (SELECT DISTINCT n, sub FROM p UNION SELECT DISTINCT n, 'none' FROM p), k AS (SELECT n, sub, count(*) AS k FROM ck GROUP BY ALL),
s AS (SELECT n, count(*) AS n_subs, count(*) FILTER (k IS NULL) AS gaps, count(*) FILTER (k = 1) AS thin FROM subs LEFT JOIN k USING (n, sub) GROUP BY n),
a AS (SELECT n, count(*) AS n_passages, count(*) FILTER (duplicate_of IS NULL) AS usable, count(DISTINCT src) AS n_sources, CAST(sum(ne) AS BIGINT) AS n_errors, CAST(sum(nw) AS BIGINT) AS n_warnings FROM ck GROUP BY n)
SELECT *, CASE WHEN n_errors > 0 THEN 'fail' WHEN n_warnings > 0 OR gaps > 0 OR thin > 0 THEN 'warn' ELSE 'ok' END AS status FROM s JOIN a USING (n)""")
def pack_report(spark, sf_dir):
    subs = t(spark, sf_dir, "documents").select(F.col("source").alias("n"), F.col("lang").alias("sub"))
    subs = subs.distinct().union(subs.select("n", F.lit("none")).distinct())
    return gr.pack_report(subs, _checked(spark, sf_dir))


def _bodies(spark, sf_dir, keep="true") -> DataFrame:
    li = t(spark, sf_dir, "lineitem").filter(keep)
    mark = F.concat(F.lit("word [E"), (F.col("l_partkey") % 12).cast("string"), F.lit("]."))
    return li.groupBy(F.col("l_orderkey").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", mark.alias("m")))), lambda x: x["m"]), " ").alias("body"))


@query("""WITH c AS (SELECT l_orderkey AS n, 'E' || (l_partkey % 12) AS id, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL), k AS (SELECT DISTINCT l_orderkey AS n, 'E' || (l_suppkey % 12) AS id FROM lineitem),
j AS (SELECT c.n, c.id, c.pos, k.id IS NOT NULL AS ok FROM c LEFT JOIN k ON c.n = k.n AND c.id = k.id)
SELECT n, coalesce(string_agg(id, ',' ORDER BY pos, id || ']') FILTER (ok), '') AS cited, coalesce(string_agg(id, ',' ORDER BY pos, id || ']') FILTER (NOT ok), '') AS bogus FROM j GROUP BY n""")
def citation_resolution(spark, sf_dir):
    known = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("n"), F.concat(F.lit("E"), (F.col("l_suppkey") % 12).cast("string")).alias("id")).distinct()
    return gr.resolve_citations(_bodies(spark, sf_dir), known).select("n", F.array_join("cited", ",").alias("cited"), F.array_join("bogus", ",").alias("bogus"))


@query("""WITH b AS (SELECT l_orderkey AS n, 'E' || (l_partkey % 12) AS id, count(*) AS b FROM lineitem WHERE l_linenumber <> 2 GROUP BY ALL), a AS (SELECT l_orderkey AS n, 'E' || (l_partkey % 12) AS id, count(*) AS a FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL),
j AS (SELECT n, id, coalesce(b, 0) - coalesce(a, 0) AS d FROM b FULL JOIN a USING (n, id))
SELECT n, id, CAST(greatest(d, 0) AS BIGINT) AS dropped, CAST(greatest(-d, 0) AS BIGINT) AS added FROM j WHERE d <> 0""")
def citation_delta(spark, sf_dir):
    return gr.citation_delta(_bodies(spark, sf_dir, "l_linenumber <> 2"), _bodies(spark, sf_dir, "l_linenumber <> 3"))


@query("""WITH c AS (SELECT user_id AS section, CASE event_id % 7 WHEN 0 THEN 'supported' WHEN 1 THEN 'supported' WHEN 2 THEN 'partial' WHEN 3 THEN 'unsupported' WHEN 4 THEN 'contradicted' ELSE 'unverified' END AS v FROM events),
a AS (SELECT section, count(*) FILTER (v = 'supported') AS supported, count(*) FILTER (v = 'partial') AS partial, count(*) FILTER (v = 'unsupported') AS unsupported, count(*) FILTER (v = 'contradicted') AS contradicted,
  count(*) FILTER (v = 'unverified') AS unverified, count(*) FILTER (v <> 'unverified') AS checked FROM c GROUP BY ALL)
SELECT *, coalesce(supported / nullif(checked, 0), 1.0) AS rate, coalesce(checked / nullif(checked + unverified, 0), 1.0) AS coverage FROM a""")
def verdict_rates(spark, sf_dir):
    v = F.element_at(F.array(*[F.lit(x) for x in ("supported", "Supported", "partial", "unsupported", "contradicted", "odd")], F.lit(None).cast("string")), (F.col("event_id") % 7 + 1).cast("int"))
    return gr.verdict_rates(t(spark, sf_dir, "events").select(F.col("user_id").alias("section"), v.alias("verdict")))


# ---- claims, works, coherence -------------------------------------------------------------------

CONFLICTS = r"""WITH c AS (SELECT user_id % 200 AS subject_entity, event_type AS predicate, CASE WHEN event_id % 3 = 0 THEN 'about ' || CAST(floor(value) AS BIGINT) ELSE 'kind ' || chr(CAST(97 + event_id % 4 AS INTEGER)) END AS object, 's' || (event_id % 5) AS source FROM events),
s AS (SELECT subject_entity, predicate, lower(trim(object)) AS side, count(*) AS n, list(DISTINCT source) AS sources, list_sort(list_distinct(regexp_extract_all(min(object), '-?\d[\d,]*(?:\.\d+)?'))) AS nums FROM c GROUP BY ALL),
g AS (SELECT subject_entity, predicate AS relation, CAST(sum(n) AS BIGINT) AS n_claims, len(list_distinct(flatten(list(sources)))) AS n_sources, count(*) AS n_sides, count(*) FILTER (len(nums) > 0) AS nn, count(DISTINCT nums) FILTER (len(nums) > 0) AS nd FROM s GROUP BY ALL)
SELECT subject_entity, relation, n_claims, CAST(n_sources AS INTEGER) AS n_sources, n_sides, CASE WHEN nn >= 2 AND nd >= 2 THEN 'numeric' ELSE 'verbal' END AS kind FROM g WHERE n_claims >= 2 AND n_sources >= 2 AND n_sides >= 2"""


@query(CONFLICTS)
def claim_conflicts(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    obj = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("about "), F.floor("value").cast("string"))).otherwise(F.concat(F.lit("kind "), F.chr(F.lit(97) + F.col("event_id") % 4)))
    claims = e.select(
        F.lit("corpus").alias("scope"), (F.col("user_id") % 200).alias("subject_entity"), F.concat(F.lit("was "), "event_type").alias("predicate"), obj.alias("object"),
        F.concat(F.lit("s"), (F.col("event_id") % 5).cast("string")).alias("source"), F.lit(None).cast("int").alias("chapter"),
    )
    return cl.conflicts(claims).select("subject_entity", "relation", "n_claims", "n_sources", "n_sides", "kind")


@query("SELECT work_id, count(*) AS n_sources, CAST(sum(n) AS BIGINT) AS n_citations FROM (SELECT l_suppkey AS source, l_partkey AS work_id, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY work_id")
def shared_works(spark, sf_dir):
    return cl.citation_graph(t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("work_id")))[1]


@query(None)
def work_match(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    works = p.select(F.concat(F.lit("W:"), F.col("p_partkey").cast("string")).alias("work_id"), F.col("p_brand").alias("author"), F.concat_ws(" ", "p_name", "p_type").alias("title"), (F.lit(1900) + F.col("p_size")).alias("year"))
    titles = p.select(F.col("p_type").alias("source"), F.col("p_type").alias("title"), F.col("p_brand").alias("author"), (F.lit(1900) + F.col("p_size")).alias("year"), F.col("p_name").alias("alias"))
    return cl.match_works(works, cl.corpus_identities(titles))


@query(f"""WITH {LABELS}, c AS (SELECT source, structural, count(*) AS n FROM lab GROUP BY ALL), b AS (SELECT source, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars FROM lab GROUP BY source),
s AS (SELECT source, string_agg(structural || '=' || n, ',' ORDER BY structural) AS structural FROM c GROUP BY source) SELECT source, chunks, chars, structural FROM b JOIN s USING (source)""")
def source_profile(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = docs.select(F.col("rowid").alias("chunk_id"), lb.structural_label(F.col("text"), F.lit("")).alias("structural"))
    none = spark.createDataFrame([], "source string, work_id string")
    p = cl.source_profile(docs, labels, _mentions(spark, sf_dir), none)
    pairs = F.array_sort(F.transform(F.map_entries("structural"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    return p.select("source", "chunks", "chars", F.array_join(pairs, ",").alias("structural"))


@query("""SELECT entity_id, n_mentioned, n_substantive, first_mention, first_substantive, n_substantive >= 3 AS redundant, coalesce(first_mention < first_substantive, false) AS forward FROM (
  SELECT l_partkey AS entity_id, count(DISTINCT l_linenumber) AS n_mentioned, count(DISTINCT CASE WHEN l_quantity > 25 THEN l_linenumber END) AS n_substantive, min(l_linenumber) AS first_mention, min(CASE WHEN l_quantity > 25 THEN l_linenumber END) AS first_substantive FROM lineitem GROUP BY ALL)""")
def concept_ledger(spark, sf_dir):
    return coherence.concept_ledger(t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("entity_id"), F.col("l_linenumber").alias("chapter"), (F.col("l_quantity") > 25).alias("substantive")))


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 9], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS i FROM w WHERE len(w) >= 10))
SELECT md5(gram) AS gram, min(doc_id) AS first_section, count(*) AS n_sections FROM g GROUP BY g.gram HAVING count(*) > 1""")
def ngram_repetition(spark, sf_dir):
    sections = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("section"), tx.tokens(F.col("text")).alias("words"))
    return coherence.repeated_ngrams(sections).withColumn("gram", F.md5("gram"))


@query(None)
def cross_refs(spark, sf_dir):
    say = F.concat(F.lit("As we saw in chapter "), (F.col("turn") % 7).cast("string"), F.lit(". "), "text", F.lit(" We will see. See chapter 3."))
    chapters = t(spark, sf_dir, "conversations").groupBy(F.col("turn").alias("chapter")).agg(F.concat_ws("\n", F.array_sort(F.collect_list(say))).alias("text"))
    return coherence.cross_references(chapters)


# ---- merges, stamps, roll-ups -------------------------------------------------------------------


@query("""WITH n AS (SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey + 1000000, c_acctbal FROM customer WHERE c_custkey % 50 = 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_name, CASE WHEN n.c_custkey IS NOT NULL AND NOT coalesce(o.c_custkey % 2 = 0, false) THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal
FROM (SELECT c_custkey, c_name, c_acctbal FROM customer) o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def upsert_protected(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.filter("c_custkey % 3 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal")).union(c.filter("c_custkey % 50 = 0").select(F.col("c_custkey") + 1_000_000, "c_acctbal"))
    return upserts.protected_upsert(c, new, ["c_custkey"], F.col("c_custkey") % 2 == 0)


@query("SELECT n_nationkey AS chapter, CASE WHEN n_nationkey % 4 = 0 THEN 'missing' WHEN n_regionkey <> 1 THEN 'stale' ELSE 'ok' END AS state FROM nation")
def staleness(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    stamps = n.filter("n_nationkey % 4 <> 0").select(F.col("n_nationkey").alias("chapter"), F.col("n_regionkey").cast("string").alias("stamp"))
    return upserts.stale(n.select(F.col("n_nationkey").alias("chapter")), stamps, "1")


@query("SELECT o_custkey AS key, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def insert_or_replace(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_totalprice")
    half = o.agg(F.max("o_orderkey")).first()[0] // 2
    return upserts.insert_or_replace(o.filter(F.col("o_orderkey") <= half), o.filter(F.col("o_orderkey") > half), ["key"], "o_orderkey")


@query("""WITH s AS (SELECT o_orderpriority AS run_id, 'c' || (o_custkey % 9) AS source, CAST(sum(o_orderkey % 10) AS BIGINT) AS passages, CAST(sum(o_orderkey % 3) AS BIGINT) AS cited FROM orders GROUP BY ALL) SELECT * FROM s""")
def run_sources(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    s = F.array(F.struct(F.concat(F.lit("c"), (F.col("o_custkey") % 9).cast("string")).alias("source"), (F.col("o_orderkey") % 10).cast("int").alias("passages"), (F.col("o_orderkey") % 3).cast("int").alias("cited")))
    return runs.merged_sources(o.select(F.col("o_orderpriority").alias("run_id"), s.alias("sources")))


@query("SELECT p_partkey, greatest(4000, least(9000, CAST(floor(p_size * 800.0 + p_retailprice * 0.25) AS INTEGER))) AS target FROM part")
def target_words(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", numeric.target_words(F.col("p_size"), F.col("p_retailprice")).alias("target"))
