"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Java regex of a word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Paths of written tables that are there, by application.
_tables: dict[str, set[str]] = {}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fresh(df: DataFrame, name: str, *others: DataFrame) -> str:
    """A column name that none of the tables has."""
    taken = {c.lower() for d in (df, *others) for c in d.columns}
    out = f"_{name}"
    while out.lower() in taken:
        out = "_" + out
    return out


def fresh_prefix(df: DataFrame, prefix: str) -> str:
    """A beginning that no column name of df has."""
    out = f"_{prefix}"
    while any(c.lower().startswith(out.lower()) for c in df.columns):
        out = "_" + out
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only on a single machine, where the session names none, is one made here; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"


@contextmanager
def _dropping_shuffles(spark: SparkSession):
    """Shuffle files of the write inside go when it ends; its result is in the written table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    _tables.setdefault(spark.sparkContext.applicationId, set()).add(path)
    with _dropping_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out


#: Tables of at most this many narrow rows may be broadcast (some 16 MB); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, name: str) -> DataFrame:
    """df written as a table, with a broadcast hint if its row count, which is checked, allows."""
    out = written(df, name)
    if out.count() > BROADCAST_ROWS:
        return out
    small = F.broadcast(out)
    small._quarry_path = out._quarry_path
    return small


#: Bounds of an Arrow batch where rows hold texts: Spark's default of 10 000 rows buffers some 100 MB a task.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def prepare(spark: SparkSession) -> None:
    """Lower the session's bounds on Arrow batches to those of BATCH.

    Queries and pipeline stages call this; whoever calls operators directly sets what suits the session.
    """
    for key, most in BATCH.items():
        # A bound of 0 rows or fewer is none; bytes may come with a unit.
        now = re.fullmatch("([0-9]+)([kmg]?)b?", str(spark.conf.get(key, str(1 << 30))).lower())
        if not now or not 0 < int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[now[2]] <= most:
            spark.conf.set(key, str(most))


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def clean_up(spark: SparkSession) -> None:
    """Delete every table that written() has made in this session; nothing that reads one may run afterwards."""
    for path in _tables.pop(spark.sparkContext.applicationId, []):
        drop_path(spark, path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by written() that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "_quarry_path", None)
    if path:
        _tables.get(spark.sparkContext.applicationId, set()).discard(path)
        drop_path(spark, path)
