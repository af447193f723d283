"""The registered queries without SQL, on a whole table, against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import bpe, common, language_model as lm, linear, media, mixing, quality_classifier as qc, quality_rules as qr, registry, secrets

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def tables(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")


def test_quality_rules(spark, sf, texts):
    docs, labels = tables(spark, sf)
    model = qr.model_for(docs, labels)
    rows = {r["doc_id"]: r for r in registry.QUERIES["op1_quality_rules"](spark, sf).collect()}
    assert set(rows) == set(texts)
    ids = sorted(texts)
    for i, (f, v) in zip(ids, linear.sparse_rows([texts[i] for i in ids], qr.FEATURES), strict=True):
        words, windows = WORD.findall(texts[i]), collections.defaultdict(list)
        for k in range(len(words) - 7):
            windows[tuple(words[k : k + 8])].append(k)
        repeated = len({k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)})
        failed = len(words) < 20 or 100 * repeated > 30 * len(words)
        p = 1 / (1 + math.exp(-(model.scale * (model.bias + float(model.weights[f].astype(float) @ v)) + model.shift)))
        r = rows[i]
        assert (r["n_words"], r["n_repeat_words"], r["base_failed"]) == (len(words), repeated, failed)
        assert r["quality_probability"] == pytest.approx(p, abs=1e-5)
        assert r["kept"] == (not failed and r["quality_probability"] >= qr.KEEP_AT)


def test_quality_classifier(spark, sf, texts):
    docs, labels = tables(spark, sf)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    rows, y = linear.training_rows(docs, labels, "quality", qc.FEATURES, qc.MAX_TRAINING_ROWS, ~qc.held_out(F.col("doc_id")))
    have = [r for r in labels.collect() if r["doc_id"] in texts and r["quality"] in (0, 1) and not held(r["doc_id"])]
    assert len(rows) == len({r["doc_id"] for r in have})
    model = qc.fit(rows, y)
    got = {r["doc_id"]: r for r in registry.QUERIES["op3_quality_classifier"](spark, sf).collect()}
    ids = sorted(texts)
    for i, (f, v) in zip(ids, linear.sparse_rows([texts[i] for i in ids], qc.FEATURES), strict=True):
        p = 1 / (1 + math.exp(-(model.bias + float(model.weights[f].astype(float) @ v))))
        assert got[i]["held_out"] == held(i) and got[i]["score"] == pytest.approx(p, abs=1e-5) and got[i]["predicted"] == int(got[i]["score"] >= 0.3)
    by = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] in (0, 1)}
    outside = [(got[i]["predicted"], by[i]) for i in ids if i in by and held(i)]
    assert outside and sum(a == b for a, b in outside) >= 0.85 * len(outside)


def test_media(spark, sf, texts):
    got = {r["doc_id"]: r for r in registry.QUERIES["op5_media"](spark, sf).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        raw = text.encode()
        padded = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        r, stored = got[i], media.store(padded)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(padded[-32:]) and (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r["codec"] == "raw" and r["duration_seconds"] == len(padded) / 48_000
        n = len(padded) // 576
        keys = [tuple(map(int, x.split("-"))) for x in r["keyframes"].split(",")]
        assert len(keys) == -(-n // media.KEY_EVERY) == int(re.search(r"keys=(\d+)", r["feature"])[1])
        for k, (lo, hi) in enumerate(keys):
            assert stored[lo:hi] == padded[576 * media.KEY_EVERY * k :][:576]


def test_bpe(spark, sf, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(bpe.public_tokenizer())
    for r in registry.QUERIES["op6_bpe"](spark, sf).collect():
        ids = t.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_language_model(spark, sf, texts):
    toks = {i: [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)), None] for i, t in texts.items()}
    training = [t for i, t in toks.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = [collections.Counter(tuple(t[i : i + k]) for t in training for i in range(len(t) - k + 1)) for k in (1, 2, 3)]
    n, v = sum(c[0].values()), len(c[0])
    lost = [collections.Counter(), collections.Counter()]
    for k in (1, 2):
        for gram, m in c[k].items():
            if m >= lm.SEEN:
                lost[k - 1][gram[:-1]] += m - lm.DISCOUNT

    def p(gram):
        if len(gram) == 1:
            return (c[0][gram] + 1) / (n + v + 1)
        k, context = len(gram) - 1, gram[:-1]
        seen = c[k - 1][context]
        if not seen or (k == 2 and seen < lm.SEEN):
            return p(gram[1:])
        m = c[k][gram]
        weight = min(1, max(1e-6, 1 - lost[k - 1][context] / seen))
        return (m - lm.DISCOUNT if m >= lm.SEEN else 0) / seen + weight * p(gram[1:])

    rows = registry.QUERIES["op8_language_model"](spark, sf).collect()
    assert len(rows) == len(toks)
    for r in rows:
        t = toks[r["doc_id"]]
        assert r["score"] == pytest.approx(sum(math.log10(p(tuple(t[max(0, i - 2) : i + 1]))) for i in range(len(t))), rel=1e-9)


def test_pipeline_rows(spark, sf, texts):
    from tokenizers import Tokenizer

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf), "test-stage")
    before = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    t = Tokenizer.from_str(bpe.public_tokenizer())
    want = collections.Counter({(i, np.asarray(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes()): n for (i, x), n in before.items()})
    got = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter((r["doc_id"], bytes(r["token_ids"])) for r in got) == want and len(got) > 50
    assert all(r["n_tokens"] * 4 == len(r["token_ids"]) for r in got)


def test_stages_keep_what_users_have(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    mine = ("kept", "mix_size", "_mix_x", "_plan_a", "secret_spans", "_base", "_spans", "_extra", "_rules_b", "lm_score", "n_words", "hub", "id", "key")
    for c in mine:
        docs = docs.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf), f"mine-{name}")
        rows = docs.collect()
        assert rows and all(r[c] == f"mine {r['doc_id']}" for r in rows for c in mine)
    scored = lm.whole_scores(docs.select("doc_id", "text", *mine[:-1]), F.lit(True)).collect()
    assert scored and all(r["kept"] == f"mine {r['doc_id']}" and isinstance(r["lm_score"], float) for r in scored)
    assert {r["mix_x"] for r in mixing.mix(docs.withColumn("mix_x", F.lit(3))).collect()} == {3}


def test_empty_stages(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_settings_and_tables(spark):
    for key, most in common.BATCH.items():
        before = spark.conf.get(key)
        spark.conf.set(key, str(most // 2))
        common.prepare(spark)
        assert spark.conf.get(key).removesuffix("b") == str(most // 2)
        spark.conf.set(key, before)
    df = common.written(spark.range(3), "test-clean")
    path = df._quarry_path
    assert df.count() == 3
    common.drop_written(df)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    assert common.fresh(spark.range(1).selectExpr("id as _X"), "x") == "__x"


def test_secret_kinds(spark):
    assert secrets.KINDS == ("assign", "access", "hex", "entropy")
    assert [len(b) for b in [list(common.BATCH)]] == [2] and pa is not None


def test_pipeline_carries_null_ids_and_repeated_rows_through_all_stages(spark, sf, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = docs.filter("length(text) between 400 and 3000").orderBy("doc_id").limit(12)
    some = clean.orderBy("doc_id").limit(4)
    no_id = clean.orderBy(F.desc("doc_id")).limit(2).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.concat("text", F.lit(" tail"))})
    empty = docs.limit(1).withColumns({"doc_id": F.lit(10**9), "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    long = clean.limit(1).withColumns({"doc_id": F.lit(10**9 + 1), "text": F.concat_ws(" ", F.sequence(F.lit(1), F.lit(60_000)).cast("array<string>"))})
    rows = clean.unionByName(some).unionByName(no_id).unionByName(empty).unionByName(long).withColumns({"key": F.lit(7), "size": F.lit("x"), "hub": F.lit(None).cast("int")})
    rows.write.parquet(f"file://{tmp_path}/in")
    now, counts = spark.read.parquet(f"file://{tmp_path}/in"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == now.columns
        out.write.parquet(f"file://{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"file://{tmp_path}/{name}")
        counts[name] = collections.Counter((r["doc_id"], r["text"]) for r in now.select("doc_id", *[c if c in now.columns else F.col("decoded").alias(c) for c in ["text"]]).collect())
        if name == "quality_rules":
            kept = counts[name]
            # Equal texts are judged alike, and null texts go.
            assert all(kept[(r["doc_id"], r["text"])] in (0, 2) for r in some.collect()) and not any(t is None for _, t in kept)
        elif name == "jaccard_join":
            assert {k for k in kept if k[0] is None} <= set(counts[name]) and set(counts[name]) <= set(kept) and all(n == kept[k] for k, n in counts[name].items())
        elif name == "secret_scans":
            assert sum(counts[name].values()) == before.count() and {i for i, _ in counts[name]} == {r["doc_id"] for r in before.collect()}
        elif name == "mixing":
            assert set(counts[name]) <= set(counts["secret_scans"])
        else:
            assert sum(counts[name].values()) == before.count() and {i for i, _ in counts[name]} == {r["doc_id"] for r in before.collect()}
