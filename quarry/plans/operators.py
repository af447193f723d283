"""Further operators applied to the driver's tables, with the SQL that gives the same rows.

Stand-ins as in queries.py: parts, suppliers and nations are works, sources and chapters, lineitem the hits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx
from ..operators import coherence, drafting as dr, entities as en, evaluation as ev, labels as lb, reports as rp, retrieval as rt, source_meta as sm, store, upserts
from ..session import shared_dir
from ..sources import files, sinks
from .queries import _fold_sql, _registry, BM25, documents, MENTIONS, _mentions, REG_SQL, SHINGLES, t
from .registry import query

# ---- store --------------------------------------------------------------------------------------


@query(f"WITH {BM25} SELECT qid, rowid, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS rank FROM sc) WHERE rank <= 10")
def bm25_stored(spark, sf_dir):
    """The index is written once and read by terms; texts aren't read for scoring."""
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    store.write_index(documents(spark, sf_dir), {"raw": tx.tokens(F.col("text"))}, path)
    long = F.array_distinct(F.filter(tx.tokens(F.col("text")), lambda x: F.length(x) > 1))
    terms = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.lit("raw").alias("stream"), F.explode(long).alias("term"))
    return store.search(spark, path, terms)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 3")
def point_lookup(spark, sf_dir):
    return store.lookup(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 3, "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1 AND 1000 AND o_orderkey % 3 = 1")
def batched_lookup(spark, sf_dir):
    return store.lookup_all(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), list(range(1, 1001, 3)), "o_orderkey")


@query("SELECT count(*) FILTER (c_custkey % 3 <> 0) AS hits, count(*) FILTER (c_custkey % 3 = 0) AS misses FROM customer")
def cache_probe(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    cache = c.filter("c_custkey % 3 <> 0").select("c_custkey", F.col("c_acctbal").alias("score"))
    return store.probed(c.select("c_custkey"), cache, ["c_custkey"])[1]


@query("""SELECT (SELECT count(*) FROM documents) AS chunks, (SELECT count(*) FROM documents WHERE doc_id % 2 = 0) AS with_context, (SELECT count(DISTINCT source) FROM documents) AS sources,
(SELECT count(*) FROM part) AS entities, (SELECT count(*) FROM part WHERE p_size > 25) AS curated_entities, (SELECT count(*) FROM supplier) AS aliases, (SELECT count(*) FROM lineitem) AS mentions,
(SELECT count(*) FROM events WHERE event_id % 3 = 0) AS claims_corpus, (SELECT count(*) FROM events WHERE event_id % 3 <> 0) AS claims_manuscript""")
def store_statistics(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").withColumn("context", F.when(F.col("doc_id") % 2 == 0, "c"))
    entities = t(spark, sf_dir, "part").select((F.col("p_size") > 25).alias("curated"))
    claims = t(spark, sf_dir, "events").select(F.when(F.col("event_id") % 3 == 0, "corpus").otherwise("manuscript").alias("scope"))
    return store.statistics(docs, docs.select("source").filter("source is not null").distinct(), entities, t(spark, sf_dir, "supplier"), t(spark, sf_dir, "lineitem"), claims)


# ---- sources ------------------------------------------------------------------------------------


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT source FROM documents WHERE doc_id % 200 = 0 AND source IS NOT NULL)")
def unmapped_sources(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    return sm.unmapped(d.filter("source is not null"), d.filter("doc_id % 200 = 0 and source is not null").select("source").distinct())


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'S ' || s_suppkey ELSE p END AS short, CASE WHEN s_suppkey % 4 = 0 THEN 'Full ' || s_name ELSE p END AS "full"
FROM (SELECT *, '*' || trim(translate(s_name || '_a-b', '_-', '  '), ' ') || '*' AS p FROM supplier)""")
def source_names(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.concat("s_name", F.lit("_a-b.md")).alias("source"))
    d = s.filter("s_suppkey % 4 = 0").select("source", F.concat(F.lit("S "), F.col("s_suppkey").cast("string")).alias("short"), F.concat(F.lit("Full "), "s_name").alias("full"))
    return sm.named(s, d).select("s_suppkey", "short", "full")


@query(f"""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN CASE WHEN s_nationkey % 2 = 0 THEN 'primary' ELSE 'tertiary' END ELSE '{sm.KIND}' END AS kind,
CASE WHEN s_suppkey % 3 = 0 THEN 'from ' || s_name ELSE '{sm.CONTRIBUTION}' END AS contribution FROM supplier""")
def source_kinds(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name", F.col("s_suppkey").cast("string").alias("source"))
    c = s.filter("s_suppkey % 3 = 0").select("source", F.when(F.col("s_nationkey") % 2 == 0, "primary").otherwise("tertiary").alias("kind"), F.concat(F.lit("from "), "s_name").alias("contribution"))
    return sm.classified(s, c).select("s_suppkey", "kind", "contribution")


def _dossiers(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    identity = F.struct(
        F.when(k % 3 != 0, F.concat(F.lit("Name "), k.cast("string"), F.lit(", X"))).alias("author"), F.when(k % 5 != 0, F.col("s_name")).alias("title"),
        F.when(k % 4 != 0, (1900 + k % 100).cast("int")).alias("year"), F.when(k % 2 == 0, "Press").alias("publisher"),
    )
    coverage = F.struct((k % 1000).cast("int").alias("period_from"), F.lit(None).cast("int").alias("period_to"), F.array(F.lit("here")).alias("geography"))
    return t(spark, sf_dir, "supplier").select(
        k.cast("string").alias("source"), identity.alias("identity"), F.when(k % 2 == 0, "primary").otherwise("secondary").alias("kind"), F.lit("g").alias("genre"), coverage.alias("coverage"),
        F.lit(None).cast("string").alias("stance"), F.lit(None).cast("array<string>").alias("reliability_notes"), F.col("s_name").alias("summary"),
    )


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS source, CASE WHEN s_suppkey % 3 = 0 THEN 'primary' WHEN s_suppkey % 2 = 0 THEN 'primary' ELSE 'secondary' END AS kind, CAST(s_suppkey % 1000 AS INTEGER) AS period_from, 1 AS places, s_name AS summary,
s_suppkey % 3 = 0 AND s_suppkey % 2 <> 0 AS disagrees FROM supplier""")
def curated_kinds(spark, sf_dir):
    d = _dossiers(spark, sf_dir)
    curated = d.filter(F.col("source").cast("long") % 3 == 0).select("source", F.lit("primary").alias("kind"))
    rows, apart = sm.synchronised(d, curated)
    flags = apart.select("source", F.lit(True).alias("d"))
    return rows.join(flags, "source", "left").select("source", "kind", "period_from", F.size("geography").alias("places"), "summary", F.coalesce("d", F.lit(False)).alias("disagrees"))


@query("""WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS source, CASE WHEN s_suppkey % 3 <> 0 THEN 'Name ' || s_suppkey END AS a, '*' || CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE CAST(s_suppkey AS VARCHAR) END || '*' AS ti,
CASE WHEN s_suppkey % 4 <> 0 THEN CAST(1900 + s_suppkey % 100 AS VARCHAR) END AS y, CASE WHEN s_suppkey % 2 = 0 THEN 'Press' END AS p FROM supplier)
SELECT source, concat_ws(', ', a, ti) AS short, concat_ws(', ', a || ', X', ti, p, y) || '.' AS "full" FROM s""")
def source_proposals(spark, sf_dir):
    return sm.proposals(_dossiers(spark, sf_dir))


# ---- drafting -----------------------------------------------------------------------------------


@query("SELECT item_id, text || CASE WHEN item_id % 7 IN (1, 2) THEN '|' || text || ' — place ' || item_id % 7 ELSE '|' || text || ' — anywhere' END AS queries FROM benchmark")
def planned_queries(spark, sf_dir):
    b = t(spark, sf_dir, "benchmark").select("item_id", "text", (F.col("item_id") % 7).alias("chapter"))
    anchors = spark.createDataFrame([(1, "place 1"), (2, "place 2")], "chapter long, anchor string")
    rows = sm.anchored(b, anchors, "anywhere")
    return rows.select("item_id", F.array_join(dr.deterministic_queries(F.col("text"), F.col("anchor")), "|").alias("queries"))


@query("""SELECT p_partkey, array_to_string(list_filter(l, lambda q, i: list_position(k, lower(trim(q))) = i), '|') AS queries
FROM (SELECT p_partkey, l, list_transform(l, lambda x: lower(trim(x))) AS k FROM (SELECT p_partkey, [p_brand, p_type, upper(p_brand), p_name] AS l FROM part))""")
def query_unions(spark, sf_dir):
    more = F.array(F.upper("p_brand"), F.lit("  "), F.col("p_name"))
    return t(spark, sf_dir, "part").select("p_partkey", F.array_join(dr.query_union(F.array("p_brand", "p_type"), more), "|").alias("queries"))


@query("SELECT p_partkey AS key, p_name AS question, left(sha1(p_name), 16) AS fingerprint FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0")
def stale_queries(spark, sf_dir):
    subs = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("question"))
    good = F.substring(F.sha1(F.col("question").cast("binary")), 1, 16)
    cache = subs.filter("key % 3 <> 0").select("key", F.when(F.col("key") % 5 == 0, "old").otherwise(good).alias("fingerprint"))
    return dr.stale_entries(subs, cache)


@query("""SELECT p_partkey, concat_ws(' ', 'From ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ', a ' || p_type ELSE '' END || '.', CASE WHEN p_partkey % 3 <> 0 THEN 'Section: ' || p_brand || '.' END,
CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'Page ' || p_size || '.' ELSE 'Pages ' || p_size || '-' || (p_size + 2) || '.' END) AS context FROM part""")
def plain_preambles(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    text = dr.context_sentence(F.col("p_name"), F.when(k % 2 == 0, F.col("p_type")).otherwise(""), F.when(k % 3 != 0, F.col("p_brand")), F.when(k % 5 != 0, size), F.when(k % 4 == 0, size).otherwise(size + 2))
    return t(spark, sf_dir, "part").select("p_partkey", text.alias("context"))


@query("""WITH m AS (SELECT user_id % 200 AS rowid, count(DISTINCT event_type) AS entities FROM events GROUP BY ALL)
SELECT rowid, entities FROM m JOIN documents ON doc_id = rowid WHERE length(text) > 500 ORDER BY entities DESC, rowid LIMIT 20""")
def claim_candidates(spark, sf_dir):
    mentions = t(spark, sf_dir, "events").select((F.col("user_id") % 200).alias("chunk_id"), F.col("event_type").alias("entity_id"))
    return dr.claim_candidates(documents(spark, sf_dir), mentions, 20).select("rowid", "entities")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) WHERE r % 7 = 0 ORDER BY r LIMIT 50")
def systematic_sample(spark, sf_dir):
    return dr.systematic_sample(t(spark, sf_dir, "orders").select("o_orderkey"), 7, 50, "o_orderkey")


@query("""WITH u AS (SELECT n_regionkey AS chapter, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS u, n_name AS unit, n_nationkey % 3 AS k FROM nation)
SELECT chapter || '.' || u || CASE WHEN s IS NULL THEN '' ELSE '.' || s END AS id, chapter, unit, CASE WHEN s IS NOT NULL THEN 'sub ' || s END AS sub FROM u LEFT JOIN (SELECT unnest([1, 2]) AS s) ON s <= k""")
def numbered_units(spark, sf_dir):
    subs = F.transform(F.slice(F.array(F.lit(1), F.lit(2)), 1, (F.col("n_nationkey") % 3).cast("int")), lambda i: F.concat(F.lit("sub "), i.cast("string")))
    n = t(spark, sf_dir, "nation").withColumn("s", F.struct("n_nationkey", F.col("n_name").alias("title"), subs.alias("subs")))
    plan = n.groupBy(F.col("n_regionkey").alias("chapter")).agg(F.transform(F.array_sort(F.collect_list("s")), lambda x: F.struct(x["title"].alias("title"), x["subs"].alias("subs"))).alias("units"))
    return dr.numbered(plan)


@query("SELECT n_regionkey AS chapter, n_name AS key, n_nationkey AS ord, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY CASE WHEN n_nationkey % 2 = 0 THEN 100 - n_nationkey ELSE 1073741824 END, n_nationkey) AS INTEGER) AS place FROM nation")
def outline_order(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("chapter"), F.col("n_name").alias("key"), F.col("n_nationkey").alias("ord"))
    return dr.outline_order(n, n.filter("ord % 2 = 0").withColumn("pos", (100 - F.col("ord")).cast("int")))


@query("""SELECT n_regionkey AS chapter, coalesce(string_agg(n_name, ',' ORDER BY n_name) FILTER (n_nationkey % 3 <> 0), '') AS planned, coalesce(string_agg(n_name, ',' ORDER BY n_name) FILTER (n_nationkey % 3 = 0), '') AS missing
FROM nation WHERE n_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 3 <> 0) GROUP BY n_regionkey""")
def plan_orphans(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("chapter"), F.col("n_name").alias("key"), "n_nationkey")
    plan = n.filter("n_nationkey % 3 <> 0").select("chapter", F.array("key", F.lit("not known")).alias("keys"))
    return dr.orphans(plan, n).select("chapter", F.array_join("planned", ",").alias("planned"), F.array_join("missing", ",").alias("missing"))


REFS = """h AS (SELECT l_orderkey % 60 AS unit, 's' || l_suppkey % 4 AS source, l_returnflag AS trail, l_orderkey * 10 + l_linenumber AS rank, 'in ' || (l_partkey % 900 + 900) || ' and ' || (1000 + l_partkey % 700) AS text, CAST(l_quantity AS DOUBLE) AS score, l_linenumber AS p FROM lineitem WHERE l_orderkey % 60 < 50),
r AS (SELECT unit, source, trail, count(*) AS n, max(score) AS score, min(p) AS page_start, max(p) + 1 AS page_end, left(string_agg(text, ' … ' ORDER BY rank, text), 800) AS excerpt FROM h GROUP BY ALL)"""


def _references(spark, sf_dir) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").filter("l_orderkey % 60 < 50")
    text = F.concat(F.lit("in "), (F.col("l_partkey") % 900 + 900).cast("string"), F.lit(" and "), (1000 + F.col("l_partkey") % 700).cast("string"))
    hits = li.select(
        (F.col("l_orderkey") % 60).alias("unit"), F.concat(F.lit("s"), (F.col("l_suppkey") % 4).cast("string")).alias("source"), F.col("l_returnflag").alias("trail"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rank"),
        text.alias("text"), F.col("l_quantity").cast("double").alias("score"), F.col("l_linenumber").alias("page_start"), (F.col("l_linenumber") + 1).alias("page_end"),
    )
    return dr.merged_references(hits)


@query(f"WITH {REFS} SELECT unit, source, trail, n, score, page_start, page_end, excerpt FROM r")
def merged_references(spark, sf_dir):
    return _references(spark, sf_dir)


@query(f"WITH {REFS} SELECT unit, source, trail, n, score, page_start, page_end, excerpt FROM (SELECT *, row_number() OVER (PARTITION BY unit, source ORDER BY score DESC, trail) AS k FROM r) WHERE k = 1")
def best_references(spark, sf_dir):
    return dr.first_references(_references(spark, sf_dir))


PLAN = REFS + f""",
y AS (SELECT unit, array_to_string(list_sort(list_distinct(flatten(list(regexp_extract_all(excerpt, '{dr.YEAR}'))))), ',') AS years, count(*) AS n, count(DISTINCT source) AS n_sources FROM r GROUP BY unit),
pl AS (SELECT unit, coalesce(n, 0) AS n, coalesce(n_sources, 0) AS n_sources, years, CASE WHEN coalesce(n, 0) = 0 THEN 'no reference' WHEN n < 3 THEN 'thin' WHEN n_sources = 1 THEN 'single source' END AS gap FROM (SELECT unnest(range(0, 60)) AS unit) LEFT JOIN y USING (unit))"""


def _plan(spark, sf_dir) -> DataFrame:
    return dr.citation_plan(spark.range(60).withColumnRenamed("id", "unit"), _references(spark, sf_dir))


@query(f"WITH {PLAN} SELECT unit, n, n_sources, years, gap FROM pl")
def citation_plans(spark, sf_dir):
    return _plan(spark, sf_dir).withColumn("years", F.array_join("years", ","))


@query(f"WITH {PLAN} SELECT unit % 5 AS chapter, count(*) AS units, CAST(sum(n) AS BIGINT) AS \"references\", count(gap) AS gaps FROM pl GROUP BY ROLLUP (unit % 5)")
def coverage_rollup(spark, sf_dir):
    return dr.coverage(_plan(spark, sf_dir).withColumn("chapter", F.col("unit") % 5))


FIGURE = "'See Fig. ' || p_size || ' of the hall. And Table ' || p_size % 5 || ' too; fig. ' || p_size || ' of the hall'"


@query(f"""WITH x AS (SELECT unit, pos, unnest(c) AS caption, unnest(range(0, len(c))) AS i FROM (SELECT p_partkey % 20 AS unit, p_partkey AS pos, regexp_extract_all({FIGURE}, '{dr.CAPTION}', 1) AS c FROM part)),
f AS (SELECT unit, lower(trim(caption)) AS key, arg_min(caption, pos * 10 + i) AS caption, min(pos * 10 + i) AS place FROM x GROUP BY ALL)
SELECT unit, CAST(rank AS INTEGER) AS rank, trim(caption) AS caption FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY place) AS rank FROM f) WHERE rank <= 8""")
def figure_captions(spark, sf_dir):
    size = F.col("p_size")
    text = F.concat(F.lit("See Fig. "), size.cast("string"), F.lit(" of the hall. And Table "), (size % 5).cast("string"), F.lit(" too; fig. "), size.cast("string"), F.lit(" of the hall"))
    return dr.figure_captions(t(spark, sf_dir, "part").select((F.col("p_partkey") % 20).alias("unit"), F.col("p_partkey").alias("pos"), text.alias("text")))


@query("""SELECT o_custkey AS chapter, o_orderkey AS section, right(lag(x) OVER w, 5) AS before, left(lead(x) OVER w, 5) AS after FROM (SELECT *, o_orderpriority || '/' || o_orderkey AS x FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def section_neighbours(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("section"), F.concat("o_orderpriority", F.lit("/"), F.col("o_orderkey").cast("string")).alias("text"))
    return dr.with_neighbours(o, 5).select("chapter", "section", "before", "after")


@query("SELECT doc_id, CAST(i // 500 AS INTEGER) AS pos, md5(substr(text, i + 1, 500)) AS digest FROM (SELECT doc_id, text, unnest(range(0, length(text), 500)) AS i FROM documents WHERE text <> '')")
def text_segments(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.posexplode(dr.segments(F.col("text"), 500)).alias("pos", "s")).select("doc_id", "pos", F.md5("s").alias("digest"))


# ---- pages --------------------------------------------------------------------------------------


@query("""WITH w AS (SELECT n_name AS source, n_nationkey AS k, unnest(range(1, n_nationkey + 4)) AS page FROM nation)
SELECT source, CAST(page AS INTEGER) AS page, CAST((row_number() OVER (PARTITION BY source ORDER BY page) - 1) // 2 AS INTEGER) AS batch FROM w WHERE (k + page) % 3 <> 0""")
def missing_pages(spark, sf_dir):
    total = t(spark, sf_dir, "nation").select(F.col("n_name").alias("source"), (F.col("n_nationkey") + 3).cast("int").alias("total"), "n_nationkey")
    done = total.select("source", "n_nationkey", F.explode(F.expr("sequence(1, total)")).alias("page")).filter("(n_nationkey + page) % 3 = 0")
    return dr.missing_pages(total, done, 2)


@query("SELECT l_suppkey % 5 AS source, l_linenumber AS page, arg_max('x' || l_partkey, l_orderkey) AS text FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey % 5, l_linenumber, l_orderkey ORDER BY l_partkey) = 1) WHERE l_returnflag = 'R' GROUP BY ALL")
def collected_pages(spark, sf_dir):
    from pyspark.sql.window import Window as W

    li = t(spark, sf_dir, "lineitem").withColumn("source", F.col("l_suppkey") % 5)
    one = F.row_number().over(W.partitionBy("source", "l_linenumber", "l_orderkey").orderBy("l_partkey"))
    rows = li.withColumn("_one", one).filter("_one = 1")
    return dr.collected_pages(rows.select("source", F.col("l_linenumber").alias("page"), F.col("l_orderkey").alias("batch_ord"), F.when(F.col("l_returnflag") == "R", "ok").otherwise("failed").alias("status"), F.concat(F.lit("x"), F.col("l_partkey").cast("string")).alias("text")))


@query("SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_size END AS page FROM part")
def book_pages(spark, sf_dir):
    text = F.concat(F.lit("head 12 of it\n  "), F.col("p_size").cast("string"), F.lit("  \nbody 345"))
    return t(spark, sf_dir, "part").select("p_partkey", dr.book_page(text).alias("page"))


STATES = """st AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unsupported' WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'up-to-date' WHEN o_orderkey % 3 = 1 THEN 'incomplete' ELSE 'due' END AS state FROM orders)"""


def _states(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    o = t(spark, sf_dir, "orders").select(k, F.concat(k.cast("string"), F.when(k % 5 == 0, ".txt").otherwise(".pdf")).alias("path"), F.to_timestamp(F.lit("2024-01-02")).alias("modificationTime"))
    written = F.when(k % 2 == 0, F.to_timestamp(F.lit("2024-01-03"))).otherwise(F.to_timestamp(F.lit("2024-01-01")))
    outputs = o.filter("o_orderkey % 3 < 2").select("path", written.alias("written"), (k % 3 == 0).alias("complete"))
    return sinks.file_state(o, outputs)


@query(f"WITH {STATES} SELECT o_orderkey, state FROM st")
def file_states(spark, sf_dir):
    return _states(spark, sf_dir).select("o_orderkey", "state")


@query(f"WITH {STATES} SELECT state AS status, count(*) AS n FROM st GROUP BY state")
def manifest(spark, sf_dir):
    return sinks.manifest(_states(spark, sf_dir).withColumnRenamed("state", "status"))


@query("""WITH f AS (SELECT p_partkey, p_size + 1 AS pages, greatest(1, least(7, CAST(floor(100 * 1048576 / greatest(1.0, p_partkey * 1048576.0 / (p_size + 1))) AS BIGINT))) AS per FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS path, CAST(lo AS INTEGER) AS lo, CAST(least(lo + per, pages) AS INTEGER) AS hi FROM (SELECT *, unnest(range(0, pages, per)) AS lo FROM f)""")
def page_parts(spark, sf_dir):
    f = t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), (F.col("p_partkey") * 1048576).alias("length"), (F.col("p_size") + 1).cast("int").alias("pages"))
    return files.page_parts(f, 100, 7)


@query("SELECT o_orderkey, '/out/' || o_custkey || '/' || o_orderkey || '.md' AS path, left(sha1('/in/' || o_orderkey || '.pdf|' || o_custkey || '|' || o_orderkey || '|m|8|100'), 16) AS key FROM orders")
def page_paths(spark, sf_dir):
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    path = dr.output_path(F.concat(F.lit("/in/"), c, F.lit("/"), k, F.lit(".pdf")), "/in/", "/out/")
    return t(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"), dr.part_key(F.concat(F.lit("/in/"), k, F.lit(".pdf")), c, k, "m", 8, 100).alias("key"))


# ---- entities -----------------------------------------------------------------------------------


@query(f"""WITH {REG_SQL}, w AS (SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '{tx.WORD.replace("'", "''")}')) AS term FROM documents), tf AS (SELECT term, {_fold_sql('term')} AS f FROM w),
st AS (SELECT folded, min(entity_id) AS e FROM al WHERE folded <> '' GROUP BY folded), lo AS (SELECT regexp_replace(folded, 'a$', '') AS lk, min(entity_id) AS e FROM al WHERE folded <> '' GROUP BY ALL)
SELECT term, coalesce(st.e, lo.e) AS entity_id FROM tf LEFT JOIN st ON f = st.folded LEFT JOIN lo ON regexp_replace(f, 'a$', '') = lk AND lk <> '' WHERE coalesce(st.e, lo.e) IS NOT NULL""")
def resolved_terms(spark, sf_dir):
    terms = documents(spark, sf_dir).select(F.explode(tx.words(F.col("text"))).alias("term")).distinct()
    return en.resolve(terms, en.aliases(_registry(spark))).filter("entity_id is not null")


@query(f"""WITH {REG_SQL}, b AS (SELECT folded, entity_id FROM al UNION SELECT regexp_replace(folded, 'a$', ''), entity_id FROM al)
SELECT folded, array_to_string(list_sort(list(DISTINCT entity_id)), ',') AS ids FROM b WHERE folded <> '' GROUP BY folded""")
def query_aliases(spark, sf_dir):
    return en.query_alias_map(en.aliases(_registry(spark))).select("folded", F.array_join("ids", ",").alias("ids"))


@query(f"""WITH {MENTIONS}, ks AS (SELECT chunk_id, entity_id AS k FROM men UNION SELECT chunk_id, folded FROM men JOIN al USING (entity_id) WHERE folded <> '')
SELECT chunk_id, array_to_string(list_sort(list(DISTINCT k)), ' ') AS stream FROM ks GROUP BY chunk_id""")
def entity_streams(spark, sf_dir):
    return en.entity_stream(_mentions(spark, sf_dir), en.aliases(_registry(spark))).select("chunk_id", F.array_join("stream", " ").alias("stream"))


@query("""WITH r AS (SELECT p_type AS type, max(p_partkey % 7) AS top FROM part GROUP BY ALL), n AS (SELECT DISTINCT p_type AS type, p_brand AS canonical FROM part)
SELECT type, canonical, 'E:' || upper(type) || ':' || lpad(CAST(top + row_number() OVER (PARTITION BY type ORDER BY canonical) AS VARCHAR), 3, '0') AS entity_id FROM n JOIN r USING (type)""")
def next_entity_ids(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    registry = p.select(F.col("p_type").alias("type"), F.concat(F.lit("E:"), F.upper("p_type"), F.lit(":"), F.lpad((F.col("p_partkey") % 7).cast("string"), 3, "0")).alias("entity_id"))
    return en.next_ids(p.select(F.col("p_type").alias("type"), F.col("p_brand").alias("canonical")).distinct(), registry)


@query(f"""WITH k AS (SELECT p_partkey AS id, {_fold_sql('substr(p_name, 1, 4 + CAST(p_partkey % 9 AS INTEGER))')} AS f FROM part)
SELECT DISTINCT 'E:' || least(a.id, b.id) AS a, 'E:' || greatest(a.id, b.id) AS b FROM k a JOIN k b ON a.id <> b.id AND a.f <> '' AND starts_with(b.f, a.f) AND length(b.f) - length(a.f) BETWEEN 1 AND 12""")
def near_dup_entities(spark, sf_dir):
    k = F.col("p_partkey")
    reg = t(spark, sf_dir, "part").select(F.concat(F.lit("E:"), k.cast("string")).alias("entity_id"), F.substring(F.col("p_name"), F.lit(1), 4 + (k % 9).cast("int")).alias("canonical"), k.alias("ord"))
    return en.near_duplicates(reg)


# ---- merges, keys, evaluation -------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 2 <> 0 AND c_custkey % 3 = 0")
def insert_or_ignore(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    return upserts.insert_or_ignore(c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name"), c.filter("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_name")), ["c_custkey"])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE s_name END AS s_name, s_nationkey FROM supplier")
def upsert_sources(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return upserts.upsert(s, s.filter("s_suppkey % 3 = 0").select("s_suppkey", F.lit("new").alias("s_name")), ["s_suppkey"])


@query("SELECT p_partkey AS k, p_size > 25 AS curated, 'old' AS v FROM part WHERE p_partkey % 2 = 0 AND NOT (p_partkey % 3 = 0 AND (p_size <= 25 OR p_partkey % 5 = 0)) UNION ALL SELECT p_partkey, p_partkey % 5 = 0, 'new' FROM part WHERE p_partkey % 3 = 0 AND (p_partkey % 5 = 0 OR NOT (p_partkey % 2 = 0 AND p_size > 25))")
def curated_merge(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    old = p.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), (F.col("p_size") > 25).alias("curated"), F.lit("old").alias("v"))
    new = p.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("k"), (F.col("p_partkey") % 5 == 0).alias("curated"), F.lit("new").alias("v"))
    return upserts.conditional_merge(old, new, "k")


@query("SELECT event_type AS scope, count(*) AS n, 'old' AS v FROM events WHERE event_type <> (SELECT min(event_type) FROM events) GROUP BY ALL UNION ALL SELECT min(event_type), 1, 'new' FROM events")
def replaced_scope(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    old = e.groupBy(F.col("event_type").alias("scope")).agg(F.count("*").alias("n")).withColumn("v", F.lit("old"))
    first = e.agg(F.min("event_type").alias("scope")).select("scope", F.lit(1).cast("long").alias("n"), F.lit("new").alias("v"))
    name = first.first()["scope"]
    return upserts.replace_scope(old, first, F.col("scope") == name)


@query("SELECT event_id, left(sha1(lower('corpus|s' || event_id % 5 || '|' || event_id || '|' || event_type || '|is|' || user_id)), 16) AS claim_id, left(sha1(lower(event_type || ' ' || user_id)), 16) AS query_hash FROM events")
def stable_ids(spark, sf_dir):
    source, user = F.concat(F.lit("s"), (F.col("event_id") % 5).cast("string")), F.col("user_id").cast("string")
    claim = tx.claim_id(F.lit("corpus"), source, F.col("event_id"), F.col("event_type"), F.lit("is"), user)
    return t(spark, sf_dir, "events").select("event_id", claim.alias("claim_id"), tx.query_hash(F.concat(F.lit(" "), "event_type", F.lit(" "), user, F.lit(" "))).alias("query_hash"))


@query("""SELECT p_partkey, concat_ws(', ', p_name, CASE WHEN p_partkey % 3 <> 0 THEN '''' || left(p_type, 80) || '''' END, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'p. ' || p_size ELSE 'pp. ' || p_size || '-' || (p_size + 2) END) AS endnote,
trim('[' || p_name || CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 4 = 0 THEN ', p. ' || p_size ELSE ', pp. ' || p_size || '-' || (p_size + 2) END || '] ' || CASE WHEN p_partkey % 3 <> 0 THEN p_brand || ' > ' || p_type ELSE '' END, ' ') AS label FROM part""")
def citation_forms(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    trail, lo, hi = F.when(k % 3 != 0, F.concat("p_brand", F.lit(" > "), "p_type")), F.when(k % 5 != 0, size), F.when(k % 4 == 0, size).otherwise(size + 2)
    return t(spark, sf_dir, "part").select("p_partkey", tx.endnote(F.col("p_name"), trail, lo, hi).alias("endnote"), tx.citation_label(F.col("p_name"), trail, lo, hi).alias("label"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(p_name || ': The (' || p_type || ')!', ' ')), '[^\p{L}\p{N}\s-]', '', 'g'), '\s+', '-', 'g') AS anchor FROM part")
def heading_anchors(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", tx.anchor(F.concat("p_name", F.lit(": The ("), "p_type", F.lit(")!"))).alias("anchor"))


@query(r"SELECT doc_id, md5(array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') <> '' AND NOT regexp_matches(x, '[\x{0900}-\x{097F}]')), chr(10))) AS latin, md5(array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[\x{0900}-\x{097F}]')), chr(10))) AS devanagari FROM documents")
def script_lines(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.md5(tx.strip_devanagari(F.col("text"))).alias("latin"), F.md5(tx.devanagari_only(F.col("text"))).alias("devanagari"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(string_split(coalesce(text, ''), '## Notes')[1], '\n\s*\n'), lambda p: length(trim(p, ' ')) > 120)) AS paragraphs FROM documents")
def paragraph_counts(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.size(coherence.paragraphs(F.col("text"))).alias("paragraphs"))


@query("WITH " + SHINGLES + """, k AS (SELECT b, min(a) AS a FROM (SELECT a, b, c / (x.n + y.n - c) AS s FROM pr JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b) WHERE s >= 0.75 GROUP BY b),
f AS (SELECT c / (x.n + y.n - c) AS s, d.source <> e.source AS cross_source FROM k JOIN pr USING (a, b) JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b JOIN documents d ON d.doc_id = a JOIN documents e ON e.doc_id = b)
SELECT count(*) AS pairs, round(min(s), 9) AS min_similarity, round(avg(s), 9) AS mean_similarity, count(*) FILTER (s < 0.9) AS below, count(*) FILTER (cross_source) AS cross_source FROM f""")
def duplicate_audit(spark, sf_dir):
    docs = documents(spark, sf_dir)
    kept = lb.near_duplicate_pairs(docs).groupBy("b").agg(F.min("a").alias("a"))
    labels = kept.select(F.col("b").alias("chunk_id"), F.array(F.lit("short:3w"), F.concat(F.lit("duplicate-of:"), F.col("a").cast("string"))).alias("issues"))
    out = lb.duplicate_audit(labels, docs, 0.9)
    return out.withColumn("min_similarity", F.round("min_similarity", 9)).withColumn("mean_similarity", F.round("mean_similarity", 9))


@query("SELECT item_id, 'G-' || CASE WHEN k < 1000 THEN lpad(CAST(k AS VARCHAR), 3, '0') ELSE CAST(k AS VARCHAR) END AS id FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) + (SELECT max(doc_id % 50) FROM labels) AS k FROM benchmark)")
def gold_ids(spark, sf_dir):
    items = t(spark, sf_dir, "labels").select(F.concat(F.lit("G-"), F.lpad((F.col("doc_id") % 50).cast("string"), 3, "0")).alias("id")).union(spark.createDataFrame([("X-900",)], "id string"))
    return ev.next_gold_ids(t(spark, sf_dir, "benchmark").select("item_id"), items, "item_id").select("item_id", "id")


@query("""WITH x AS (SELECT 'even' AS v, 0 AS o, label % 2 = 0 AS k, embedding[1]::DOUBLE AS e FROM embeddings UNION ALL SELECT 'odd', 1, label % 2 = 1, embedding[1]::DOUBLE FROM embeddings)
SELECT o AS ord, v AS variant, 'labels ' || v AS description, count(*) AS n FROM x WHERE k GROUP BY ALL""")
def sweep_variants(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings")
    run = lambda cfg: e.filter(F.col("label") % 2 == cfg["keep"]).agg(F.count("*").alias("n"))
    return ev.sweep({"keep": 5}, {"even": {"_desc": "labels even", "keep": 0}, "odd": {"_desc": "labels odd", "keep": 1}}, run)


@query("""WITH o AS (SELECT n_nationkey AS chapter, n_name AS title, CASE WHEN n_nationkey % 3 <> 0 THEN 'written by ' || n_name END AS text FROM nation)
SELECT CAST(sum(CASE WHEN text IS NULL THEN 0 ELSE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) END) AS BIGINT) AS words, count(*) FILTER (text IS NULL) AS missing,
md5(string_agg(coalesce(text, '# ' || title || chr(10) || chr(10) || '[not yet written]'), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY chapter)) AS markdown FROM o""".replace("\\\\", "\\"))
def manuscript(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("chapter"), F.col("n_name").alias("title"))
    chapters = n.filter("chapter % 3 <> 0").select("chapter", F.concat(F.lit("written by "), "title").alias("text"))
    return sinks.assembled(n, chapters).withColumn("markdown", F.md5("markdown"))


@query("""SELECT label AS section, count(*) AS n_sentences, count(*) FILTER (vec_id % 3 = 0) AS n_cited, round(count(*) FILTER (vec_id % 3 = 0) / count(*), 4) AS completeness, count(*) FILTER (vec_id % 3 <> 0) AS uncited_factual FROM embeddings GROUP BY label""")
def citation_completeness(spark, sf_dir):
    k = F.col("vec_id")
    s = F.concat(F.lit("A sentence of some length about number "), k.cast("string"), F.when(k % 3 == 0, " [E12]").otherwise(""), F.lit("."))
    sections = t(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("section")).agg(F.array_join(F.array_sort(F.collect_list(s)), " ").alias("text"))
    return rp.citation_metrics(sections).withColumn("completeness", F.round("completeness", 4))


@query("""WITH f AS (SELECT label AS sub, vec_id AS rowid, embedding[1]::DOUBLE AS score FROM embeddings), k AS (SELECT sub, count(*) FILTER (score > 0) AS n FROM f GROUP BY sub)
SELECT sub, count(*) AS fused, n AS above, (SELECT count(*) FROM f g WHERE g.sub = f.sub AND g.rowid % 2 = 0) AS dense FROM f JOIN k USING (sub) GROUP BY sub, n""")
def retrieval_records(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings").select(F.col("label").alias("sub"), F.col("vec_id").alias("rowid"), F.col("embedding")[0].cast("double").alias("score"))
    fused = e.select("sub", "rowid", F.lit(1).alias("rank"), F.array(F.lit("sparse")).alias("channels"), "score")
    channels = e.filter("rowid % 2 = 0").select("sub", F.lit("dense").alias("channel"), "rowid")
    rec = rp.retrieval_record(e.select("sub").distinct(), channels, fused, e.filter("score > 0"), "none", "relative")
    return rec.select("sub", "record.counts.fused", F.col("record.n_above_floor").alias("above"), "record.counts.dense")
