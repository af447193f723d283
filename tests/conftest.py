import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g").config("spark.checkpoint.dir", f"file://{shared}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def oracle(sf):
    import duckdb

    con = duckdb.connect()
    for n in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {n} as select * from '{sf}/{n}.parquet'")
    return con


def _norm(v):
    return tuple(map(_norm, v)) if isinstance(v, list | tuple) else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="session")
def same(spark, oracle, sf):
    """Does a query give the rows of its SQL?"""

    def check(f, sql):
        df = f(spark, sf)
        cols = sorted(df.columns)
        got = sorted(_norm(tuple(r)) for r in df.select(*cols).collect())
        want = sorted(_norm(r) for r in oracle.execute("select " + ",".join(f'"{c}"' for c in cols) + f" from ({sql})").fetchall())
        assert got == want

    return check
