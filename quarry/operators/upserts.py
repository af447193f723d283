"""Merges without MERGE: a table and new rows give the table to write next.

Write the result to a new place and swap; never overwrite what is being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace the columns they bring; columns that only old has stay."""
    brought = [c for c in new.columns if c not in keys]
    n = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in brought], F.lit(True).alias("_new"))
    cond = [old[k].eqNullSafe(n[f"_k_{k}"]) for k in keys]
    rows = old.join(n, cond, "full_outer")
    out = [F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys]
    out += [F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in brought else F.col(c) for c in old.columns if c not in keys]
    out += [F.col(f"_n_{c}").alias(c) for c in brought if c not in old.columns]
    return rows.select(*out)


def protected_upsert(old: DataFrame, new: DataFrame, keys: list[str], protected) -> DataFrame:
    """upsert, but rows of old that meet `protected` stay as they are."""
    kept = old.filter(protected).select(*keys)
    return upsert(old, new.join(kept, keys, "left_anti"), keys)


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def insert_or_replace(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of several rows of a key the one of the largest `order` stays, and a new one before an old one."""
    rows = old.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_n"), F.desc(order)))).filter("_r = 1").drop("_n", "_r")


def conditional_merge(old: DataFrame, new: DataFrame, key: str, flag: str = "curated") -> DataFrame:
    """A flagged old row is never replaced by an unflagged new one."""
    shield = old.filter(F.col(flag)).select(key)
    rows = new.join(shield.withColumn("_s", F.lit(True)), key, "left").filter(F.col(flag) | F.col("_s").isNull()).drop("_s")
    return old.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def replace_scope(old: DataFrame, new: DataFrame, scope) -> DataFrame:
    """Rows of old that meet `scope` give way to new."""
    return old.filter(~F.coalesce(scope, F.lit(False))).unionByName(new, allowMissingColumns=True)


def stale(items: DataFrame, stamps: DataFrame, current: str, key: str = "chapter") -> DataFrame:
    """(key, state): missing, stale or ok, by equality of stamps."""
    rows = items.select(key).join(stamps.select(key, "stamp"), key, "left")
    return rows.select(key, F.when(F.col("stamp").isNull(), "missing").when(F.col("stamp") != current, "stale").otherwise("ok").alias("state"))


def fingerprint(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: a digest of the rows whatever their order, by hashes that add up on the way."""
    h = F.xxhash64(*columns).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("n"), F.sum(h).alias("a"), F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)")).alias("b")).select(F.sha2(F.concat_ws("|", "n", "a", "b"), 256).alias("fingerprint"))
