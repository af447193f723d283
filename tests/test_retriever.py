from quarry.__main__ import main
from quarry.plans.retriever import Retriever


def test_packs(spark, capsys):
    rows = [(i, f"s{i % 3}", t) for i, t in enumerate(["Bhoja built the temple at Dhara", "the temple of Bhojadeva", "rivers and hills", "a grammar of verbs", None, "temple temple temple"])]
    chunks = spark.createDataFrame(rows, "rowid long, source string, text string")
    registry = spark.createDataFrame([("E:P:001", "Bhoja", "person", ["Bhojadeva"], True)], "entity_id string, canonical string, type string, aliases array<string>, curated boolean")
    labels = spark.createDataFrame([(5, False, 0.1)], "chunk_id long, retrievable boolean, quality double")
    from quarry.operators import models

    vectors = models.embed(chunks.na.fill("", ["text"]), models.StubClient).select("rowid", "embedding")
    q = spark.createDataFrame([("a", 0, "Who was Bhoja?"), ("a", 1, "temple"), ("b", 0, "???")], "sub string, query_ord int, query string")
    sparse, status = Retriever(chunks, registry=registry, labels=labels).packs(q)
    assert {r["rowid"] for r in sparse.collect()} == {0}  # 5 is not retrievable, b asks nothing, flat scores fall fast
    assert {r["sub"]: r["status"] for r in status.collect()} == {"a": "THIN", "b": "GAP"}
    scores = spark.createDataFrame([("a", 0, 0.8), ("a", 1, 0.7), ("a", 2, 0.1)], "sub string, rowid long, score double")
    kept, status = Retriever(chunks, registry=registry, labels=labels).packs(q, backend="hosted", scores=scores)
    assert {r["rowid"] for r in kept.collect()} == {0, 1}
    kept, _ = Retriever(chunks, vectors, registry, labels=labels).packs(q)
    assert 5 not in {r["rowid"] for r in kept.collect()} and kept.select("sub", "rowid").distinct().count() == kept.count()
    assert main(["list"]) == 0 and "bm25_topk" in capsys.readouterr().out
    assert main(["config"]) == 0 and main(["sql", "bm25_topk"]) == 0
