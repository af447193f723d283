"""Secret scans: the SQL at the scale that the driver compares, long texts, clashing names."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.llm import secrets


def test_same_as_sql_at_the_next_scale(spark, sf):
    larger = f"{sf}/../sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{larger}/documents.parquet'")
    df = secrets.op9_secret_scans(spark, larger)
    cols = sorted(df.columns)
    got = sorted(tuple(r) for r in df.select(*cols).collect())
    assert got == sorted(con.sql(f"select {','.join(cols)} from ({secrets.OP9_SQL})").fetchall())
    kinds = {s.split(":")[0] for r in got for s in r[cols.index("spans")].split(",") if s}
    assert kinds >= {"assign", "hex"}


def test_sql_keeps_repeated_ids_apart(spark, tmp_path):
    rows = [(1, "token=abcdef"), (1, "token=abcdef"), (1, None), (2, ""), (None, "AKIA" + "A" * 20), (3, "x " + "deadbeef" * 3)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    df = secrets.op9_secret_scans(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, con.sql(f"select {','.join(df.columns)} from ({secrets.OP9_SQL})").fetchall()))


@pytest.mark.parametrize(("name", "n_base", "n_all"), [("slugs", 0, 0), ("assigned", 75_000, 75_000), ("one run", 0, 1), ("both", 12_000, 24_000)])
def test_long_texts(spark, name, n_base, n_all):
    rnd = random.Random(3)
    run = "".join(rnd.choice(secrets.ALPHABET) for _ in range(1 << 20))
    text = {
        "slugs": "a-1-" * (1 << 18), "assigned": "token=abcdef " * 75_000, "one run": run,
        # Shuffled alphabets have more bits than any limit; no letter of "token=..." is next to them.
        "both": " ".join("token=abcdef " + "".join(rnd.sample(secrets.ALPHABET[:62], 40)) for _ in range(12_000)),
    }[name]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    t = time.time()
    row = secrets.scan(docs).select(F.size("secret_base").alias("b"), F.size("secret_spans").alias("s")).first()
    assert (row["b"], row["s"]) == (n_base, n_all)
    redacted = secrets.redact(docs).first()["text"]
    assert redacted.count("[SECRET]") == n_all and ("token" in redacted) == False  # noqa: E712
    assert time.time() - t < 60


def test_running_over_several_runs(spark):
    rnd = random.Random(5)
    for n in (1, 2, secrets.RUN, secrets.RUN + 1, 5 * secrets.RUN + 3):
        x = [rnd.randint(0, 9) for _ in range(n)]
        df = spark.createDataFrame([(x,)], "x array<int>")
        sums, tops = df.select(secrets.running_sums(F.col("x")), secrets.running(F.col("x"), lambda a, b: F.greatest(a, b), F.lit(0), "int")).first()
        assert sums == [sum(x[: i + 1]) for i in range(n)] and tops == [max(x[: i + 1]) for i in range(n)]


def test_overlaps_with_base_spans(spark):
    rnd = random.Random(11)
    for _ in range(20):
        cuts = sorted(rnd.sample(range(60), 2 * rnd.randint(0, 8)))
        cand = [(a, 3, b, "x") for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        base = sorted((a, rnd.randint(0, 2), a + rnd.randint(1, 9)) for a in rnd.sample(range(60), rnd.randint(0, 5)))
        df = spark.createDataFrame([(cand, base)], f"c {secrets.CANDIDATES}, b {secrets.SPAN}")
        got = [tuple(x) for x in df.select(secrets._clear(F.col("c"), F.col("b"))).first()[0]]
        assert got == [c for c in cand if not any(b[0] < c[2] and c[0] < b[2] for b in base)]


def test_clashing_names_and_nulls(spark):
    rows = [(1, "a token=abcdef1 b"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("_hex", "_assign", "_candidates", "_found", "_base", "_spans", "secret_spans", "secret_base", "n_chars"):
        docs = docs.withColumn(c, F.lit(7).cast("int"))
    out = secrets.redact(docs)
    assert out.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["text"] for i in (1, 2, 3)] == ["a [SECRET] b", None, ""] and got[1]["n_chars"] == 12
    assert all(r[c] == 7 for r in got.values() for c in ("_hex", "_assign", "_candidates", "_found", "_base", "_spans", "secret_spans", "secret_base"))
    found = secrets.scan(docs)
    assert found.filter("size(secret_spans) > 0").count() == 1 and {r["_hex"] for r in found.collect()} == {7}
    assert secrets.redact(docs.limit(0)).count() == 0


def test_neighbours_and_nested_spans(spark):
    rows = [([(0, 0, 3), (3, 2, 6)], "abcdefgh"), ([(0, 0, 6), (1, 2, 3), (2, 2, 8)], "abcdefgh"), ([(1, 0, 2), (4, 1, 5), (4, 2, 6)], "äbçdéf漢h"), ([], "abc")]
    df = spark.createDataFrame(rows, f"s {secrets.SPAN}, t string")
    assert [r[0] for r in df.select(secrets.redacted(F.col("t"), "s", "#")).collect()] == ["##gh", "#", "ä#çd#漢h", "abc"]
