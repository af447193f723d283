"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key -ln(u) / w, u from a hash of its id and w its
quality weight; within a source the documents in key order are a weighted sample
without replacement.  A source's target is complete epochs first, then the shortest
prefix of that order whose size comes nearest to the rest.

The prefix is found without sorting a source in one task: sizes are summed in
key ranges per source, and only the range that the budget ends in is ordered.  Ranges are equal in the
logarithm of the key, ``RANGES`` to each factor of e: a weight only shifts that, and an exponential's logarithm is
nowhere denser than 1 / e, so no range holds more than some 1 / (e * RANGES) of a source's rows, whatever their weights.  The outcome is one key threshold per source, so the decision on a document
is a projection: texts are never shuffled.

Nulls: a null text has size 0; a null source is a source of its own, last in order; a
null id draws its key from the word "null".  Rows that repeat an id, and others whose keys
tie, are taken together.  Empty texts have size 0 and are not taken; a very long text is taken
or not as a whole.  An empty table gives an empty result.  Extra columns are kept, whatever
their names; those named like the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from ..operators.numbering import numbered
from .common import drop_written, fresh_prefix, table, written, WORD

SOURCE_WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGES = 256
#: Sources up to this many rows are broadcast; beyond, the source table is joined by a shuffle.
BROADCAST_SOURCES = 100_000
SYMBOLS = r"[#*$%&|<>]"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """In (0, 1]: near 1 for prose, small where symbols are as many as words."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))
    return (n_words(text) + 1.0) / (n_words(text) + 1.0 + 4.0 * symbols)


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / w, with u of 52 bits in (0, 1) from the MD5 of the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def key_range(key: Column) -> Column:
    return F.floor(F.log(key) * RANGES).cast("int")


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: (source, source_size).  Adds target: weights share the total, no target above max_epochs sizes.

    Resharing the excess until none is above equals one common level per unit of weight, the largest of the levels
    reached after capping the k sources of least cap per weight.  Sources are numbered by ranges; caps are summed in order over
    the distinct pairs of size and weight, for sources that have both in common reach their caps together.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], name="rank", write=written)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs))
    kinds = ranked.groupBy("weight", "cap").agg(F.count("*").alias("n"), F.sum("source_size").alias("size"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "weight", "cap")
    steps = kinds.select(
        F.coalesce(F.sum(F.col("cap") * F.col("n")).over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum(F.col("weight") * F.col("n")).over(by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("weight_left"), F.sum("size").over(W.partitionBy()).alias("total"),
    )
    level = steps.agg(F.max((F.col("total") - F.col("capped")) / F.col("weight_left")).alias("level"))
    return ranked.crossJoin(F.broadcast(level)).select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))  # one row


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS, prefix: str = "mix_") -> DataFrame:
    """docs with size, source_size, target and taken (words taken, repeats counted), named after the prefix; columns of those names are replaced."""
    size_col, source_size_col, target_col, taken_col = (prefix + c for c in ("size", "source_size", "target", "taken"))
    docs = docs.drop(size_col, source_size_col, target_col, taken_col)
    own = fresh_prefix(docs, "plan_")
    key = exponential_key(F.col(id_col), quality_weight(F.col(text_col)))
    keyed = written(docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), key.alias("key")), "mix-keys")
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = written(
        targets.withColumn("epochs", epochs.cast("long")).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets"
    )
    small = (lambda df: F.broadcast(df)) if targets.count() <= BROADCAST_SOURCES else (lambda df: df)

    ranged = keyed.withColumn("bucket", key_range(F.col("key")))
    order = W.partitionBy("source").orderBy("bucket")
    ends = (
        ranged.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
        .withColumn("before", F.sum("n").over(order) - F.col("n"))
        .join(small(targets.select(F.col("source").alias("t_source"), "budget")), F.col("source").eqNullSafe(F.col("t_source")))
        .filter("before <= budget")
        .groupBy("source")
        .agg(F.max_by(F.struct("bucket", "before", "budget"), "bucket").alias("e"))
        .select(F.col("source").alias("e_source"), "e.*")
    )
    inside = W.partitionBy("source").orderBy("key")
    thresholds = (
        ranged.join(small(ends.withColumnRenamed("bucket", "e_bucket")), F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket")))
        .groupBy("source", "key", "before", "budget").agg(F.sum("size").alias("n"))
        .withColumn("mid", F.col("before") + F.sum("n").over(inside) - F.col("n") / 2.0)
        .groupBy("source")
        .agg(F.max(F.when(F.col("mid") <= F.col("budget"), F.col("key"))).alias("last_key"), F.min("key").alias("first_key"))
        .select(F.col("source").alias("k_source"), "last_key", "first_key")
    )
    at = lambda c: F.col(own + c)
    plan = written(targets.join(thresholds, F.col("source").eqNullSafe(F.col("k_source")), "left").select(
        F.col("source").alias(own + "source"), F.col("source_size").alias(source_size_col), F.col("target").alias(target_col), F.col("epochs").alias(own + "epochs"),
        F.coalesce("last_key", "first_key").alias(own + "end"), F.col("last_key").isNotNull().alias(own + "closed"), F.col("budget").alias(own + "budget"),
    ), "mix-plan")
    drop_written(keyed)
    drop_written(targets)
    chosen = (at("budget") > 0) & ((at("key") < at("end")) | (at("closed") & (at("key") == at("end"))))
    return (
        docs.withColumn(size_col, n_words(F.col(text_col)))
        .withColumn(own + "key", key)
        .join(small(plan), F.col(source_col).eqNullSafe(at("source")))
        .withColumn(taken_col, (F.col(size_col) * (at("epochs") + F.when(chosen, 1).otherwise(0))).cast("long"))
        .drop(*[own + c for c in ("key", "source", "epochs", "end", "closed", "budget")])
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of docs."""
    own = fresh_prefix(docs, "mix_")
    size, taken, times = F.col(own + "size"), F.col(own + "taken"), F.col(own + "times")
    mixed = mix(docs, prefix=own, **options).withColumn(own + "times", F.when(size > 0, taken / size).otherwise(0).cast("int"))
    return mixed.filter(times > 0).withColumn(own + "time", F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


OP10_SQL = r"""
WITH keyed AS (
  SELECT doc_id, source, s AS size,
         -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
           / ((s + 1.0) / (s + 1.0 + 4.0 * sym)) AS key
  FROM (SELECT doc_id, source,
               CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS s,
               coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS sym
        FROM documents)),
ranked AS (
  SELECT source, source_size, 3.0 * source_size AS cap, rk,
         CASE (rk - 1) % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 3.0 END AS weight, sum(source_size) OVER () AS total
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM keyed GROUP BY source)),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM ranked),
targets AS (
  SELECT source, source_size, CAST(least(cap, max(lv) OVER () * weight) AS DOUBLE) AS target FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
placed AS (
  SELECT k.*, sum(size) OVER (PARTITION BY source ORDER BY key) - sum(size) OVER (PARTITION BY source, key) / 2.0 AS mid FROM keyed k)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CAST(p.size * (t.epochs + CASE WHEN p.mid <= t.target - t.epochs * t.source_size AND t.target - t.epochs * t.source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed p JOIN plan t ON p.source IS NOT DISTINCT FROM t.source
"""
