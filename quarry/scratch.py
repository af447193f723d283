"""Tables written in the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .session import shared_dir

#: Paths that are there, by application.
_tables: dict[str, set[str]] = {}

#: Tables of at most this many narrow rows may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def new_path(spark: SparkSession, name: str) -> str:
    """A path that clean_up() deletes."""
    path = f"{shared_dir(spark)}/quarry-tables/{name}-{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as a Parquet table and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """df written, with a broadcast hint where its row count, which is checked, allows."""
    out = written(df, name)
    return F.broadcast(out) if out.count() <= (BROADCAST_ROWS if most is None else most) else out


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def clean_up(spark: SparkSession) -> None:
    """Delete every table of this session; nothing that reads one may run afterwards."""
    for path in _tables.pop(spark.sparkContext.applicationId, []):
        drop_path(spark, path)
