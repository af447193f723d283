"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def get_spark(app: str = "quarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings come from spark-submit."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to Python workers once a context, for clusters started without --py-files."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-zip-"), "quarry_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  One is made only on a single machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")
