"""Operators that used to send everything to one task or to compare everything with everything: same results, other plans."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import claims as cl, drafting as dr, evaluation as ev, passes
from quarry.sources import files, ocr


def plan(df):
    return df._jdf.queryExecution().toString()


def test_batches_chunk_files_and_samples_have_no_single_task(spark, tmp_path):
    rows = spark.range(1000).select(F.format_string("t%04d", "id").alias("term"), F.lit(1).alias("n")).repartition(5)
    out = passes._batched(rows, "term", 120, F.col("term"))
    assert "SinglePartition" not in plan(out)
    got = {r["batch"]: [i["row"]["term"] for i in r["items"]] for r in out.collect()}
    assert got == {b: [f"t{i:04d}" for i in range(120 * b, min(1000, 120 * b + 120))] for b in range(9)}
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps({"source": s, "chunk": c, "text": f"{s}{c}"}) for s, c in [("b", 1), ("a", 2), ("b", 0), ("a", 1)]))
    chunks = files.chunk_file(spark, str(tmp_path / "c.jsonl"))
    assert "SinglePartition" not in plan(chunks) and {r["text"]: r["rowid"] for r in chunks.collect()} == {"a1": 0, "a2": 1, "b0": 2, "b1": 3}
    sample = dr.systematic_sample(spark.range(100).repartition(7), 9, 5, "id")
    assert [r["id"] for r in sample.collect()] == [0, 9, 18, 27, 36]


def test_bootstrap_returns_a_row_a_partition(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(3, 2, 5000)
    df = spark.createDataFrame([(float(x),) for x in v], "value double").repartition(6)
    got = ev.bootstrap_ci(df, samples=500)
    assert "Nested" not in plan(got) and "Cartesian" not in plan(got)
    r = got.first()
    half = 1.96 * v.std() / np.sqrt(len(v))
    assert r["mean"] == pytest.approx(v.mean()) and r["lo"] == pytest.approx(v.mean() - half, abs=0.02) and r["hi"] == pytest.approx(v.mean() + half, abs=0.02)
    assert tuple(ev.bootstrap_ci(spark.createDataFrame([(None,)], "value double"), samples=10).first()) == (None, None, None)
    times = ev._poisson(np.arange(20_000), 20, 11)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and (times == ev._poisson(np.arange(20_000), 20, 11)).all()


def scored(w, i, rare):
    common = set(w["tt"]) & set(i["title_tokens"])
    a, b = w["tf"], i["title_fold"]
    inside = min(len(a), len(b)) >= 12 and (a in b or b in a)
    title = 3 if inside else 2 if len(common & rare) >= 2 else 1 if common & rare or len(common) >= 2 else 0
    s = title + (3 if a and a in i["aliases"] else 0) + (2 if w["sn"] and w["sn"] in i["surnames"] else 0)
    return s + (1 if s and w["year"] in i["years"] else 0)


def test_works_match_as_if_every_pair_were_scored(spark):
    r = random.Random(5)
    words = "temple river granite lintel charter dynasty pillar grammar coinage archive mandala vessel".split()
    title = lambda n: " ".join(r.choice(words) for _ in range(n))
    names = ["Mason, Stella", "Brown, Percy", "Stone, A", "Field, B", None]
    ids = [(f"s{i:02d}", r.choice(names), title(r.randint(1, 5)), r.choice([1900, 1950, None]), title(2) if i % 3 else None) for i in range(40)] + [("same", None, "History of the great granite temples", None, "hgt")]
    works = [(f"W{i}", r.choice(names), r.choice([title(r.randint(0, 4)), ids[i % 40][2] + " and " + title(1), None]), r.choice([1900, 1950])) for i in range(120)]
    works += [("Wx", None, "great granite temples", None), ("Wy", None, "The History of the great granite temples, volume two", None), ("W0", None, None, None)]
    identities = cl.corpus_identities(spark.createDataFrame(ids, "source string, author string, title string, year int, alias string"))
    table = spark.createDataFrame(works, "work_id string, author string, title string, year int")
    got = cl.match_works(table, identities)
    assert not any(x in plan(got) for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    from quarry.functions import text as tx

    w = table.select("work_id", "year", tx.surname(F.col("author")).alias("sn"), tx.fold(F.coalesce("title", F.lit(""))).alias("tf"), cl.title_tokens(F.col("title")).alias("tt")).collect()
    known = identities.collect()
    df = {}
    for i in known:
        for t in set(i["title_tokens"]):
            df[t] = df.get(t, 0) + 1
    rare, want = {t for t, n in df.items() if n == 1}, {}
    for x in w:
        s, source = max(((scored(x, i, rare), i["source"]) for i in known), key=lambda p: (p[0], [-ord(c) for c in p[1]]))
        if s >= 2 and s > want.get(x["work_id"], (0, ""))[0]:
            want[x["work_id"]] = (s, source)
    assert {r["work_id"]: (r["score"], r["source"]) for r in got.collect()} == want and len(want) > 60 and want["Wx"] == (3, "same") and want["Wy"] == (3, "same")


def test_contained_strings_meet_on_their_rarest_run(spark):
    r = random.Random(6)
    text = lambda n: "".join(r.choice("ab") for _ in range(n))
    long = [text(r.randint(5, 60)) for _ in range(60)] + ["x" * 30]
    short = [s[k : k + r.randint(10, 20)] for s in long for k in (0, 7)] + [text(14) for _ in range(40)] + ["x" * 12, "x" * 31, ""]
    got = cl.contained_pairs(spark.createDataFrame([(s,) for s in short], "s string"), spark.createDataFrame([(s,) for s in long], "t string"))
    assert sorted(map(tuple, got.collect())) == sorted({(s, l) for s, l in itertools.product(short, long) if len(s) >= 12 and s in l})


# ---- resumable reading --------------------------------------------------------------------------


def pages(folder):
    """A client class of its own, which goes to the workers by value."""

    class Pages:
        """Reads a page, and fails on those whose name is in a file; asked names are appended to another."""

        def __init__(self, folder):
            self.folder = folder

        def read_layout(self, url):
            import base64
            import time

            name = base64.b64decode(url.split(",", 1)[1]).decode()
            with open(f"{self.folder}/asked", "a") as f:
                f.write(name + "\n")
            if name in open(f"{self.folder}/bad").read().split():
                time.sleep(5)  # tasks beside it end first
                raise KeyboardInterrupt(name)  # not an error of a page: the task ends
            return f"raw {name}"

    return lambda: Pages(folder)


def test_a_stopped_reading_asks_only_for_the_rest(spark, tmp_path):
    folder, path = str(tmp_path), f"file://{tmp_path}/layouts"
    images = spark.createDataFrame([("s", i, f"p{i}.png", bytearray(f"p{i}", "ascii")) for i in range(40)], "source string, page int, path string, content binary")
    (tmp_path / "bad").write_text("p7")
    with pytest.raises(Exception):  # noqa: B017
        ocr.layouts_resumed(images, pages(folder), path, pages_a_task=4).count()
    kept = {r["page"] for r in spark.read.parquet(path).collect()}
    assert kept and 7 not in kept and len(kept) < 40
    (tmp_path / "bad").write_text("")
    (tmp_path / "asked").write_text("")
    got = ocr.layouts_resumed(images, pages(folder), path, pages_a_task=4).collect()
    assert {r["page"]: r["raw"] for r in got} == {i: f"raw p{i}" for i in range(40)} and len(got) == 40
    assert {int(x[1:]) for x in (tmp_path / "asked").read_text().split()} == set(range(40)) - kept
    (tmp_path / "asked").write_text("")
    assert ocr.layouts_resumed(images, pages(folder), path).count() == 40 and (tmp_path / "asked").read_text() == ""
