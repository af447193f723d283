"""Run records: stages with metrics, merged sources, one JSON row a run."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Stage:
    name: str
    index: int
    status: str = "ok"
    seconds: float = 0.0
    metrics: dict = field(default_factory=dict)
    warnings: list = field(default_factory=list)
    errors: list = field(default_factory=list)
    sources: list = field(default_factory=list)

    def warn(self, text: str) -> None:
        self.warnings.append(text)
        self.status = "fail" if self.errors else "warn"

    def error(self, text: str) -> None:
        self.errors.append(text)
        self.status = "fail"


@dataclass
class Run:
    chapter: int
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    stages: list[Stage] = field(default_factory=list)

    @contextmanager
    def stage(self, name: str):
        """A stage that times its block; an exception is recorded with it and raised again."""
        s = Stage(name, len(self.stages))
        self.stages.append(s)
        t = time.monotonic()
        try:
            yield s
        except Exception as e:
            s.error(f"{type(e).__name__}: {e}")
            raise
        finally:
            s.seconds = time.monotonic() - t

    @property
    def status(self) -> str:
        states = {s.status for s in self.stages}
        return "fail" if "fail" in states else "warn" if "warn" in states else "ok"

    def rows(self, spark: SparkSession) -> DataFrame:
        schema = "run_id string, chapter int, name string, idx int, status string, seconds double, metrics map<string,string>, sources array<struct<source:string,passages:int,cited:int>>"
        data = [(self.run_id, self.chapter, s.name, s.index, s.status, s.seconds, {k: str(v) for k, v in s.metrics.items()}, [(x.get("source"), x.get("passages"), x.get("cited")) for x in s.sources]) for s in self.stages]
        return spark.createDataFrame(data, schema)


def merged_sources(stages: DataFrame) -> DataFrame:
    """(run_id, source, passages, cited) over a run's stages: numbers add up; most passages first."""
    rows = stages.select("run_id", F.explode("sources").alias("s")).groupBy("run_id", F.col("s.source").alias("source"))
    return rows.agg(F.sum("s.passages").alias("passages"), F.sum("s.cited").alias("cited")).orderBy("run_id", F.desc_nulls_last("passages"), "source")


def save(stages: DataFrame, path: str) -> None:
    nested = stages.groupBy("run_id", "chapter").agg(F.array_sort(F.collect_list(F.struct("idx", "name", "status", "seconds", "metrics", "sources"))).alias("stages"))
    nested.write.mode("append").json(path)
