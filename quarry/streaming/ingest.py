"""Incremental ingestion: new files become chunks and counts without reading old ones again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx


def read_new(spark: SparkSession, path: str, schema, files_at_once: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("rowid"), F.explode(tx.tokens(F.col(text_col))).alias("token"))


def append(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """To a file sink; the checkpoint remembers what was written, so a restart goes on where it stopped."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()


def _timed(events: DataFrame) -> DataFrame:
    """Watermarks need timestamps with a time zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def event_windows(events: DataFrame, size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; what comes later than `late` is left out."""
    out = _timed(events).withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    out = _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def distinct_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    return _timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
