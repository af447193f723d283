"""The manifest against a tree built by hand in plain Python, and its edge cases."""

import hashlib
import zlib

from pyspark.sql import functions as F

from quarry.llm import merkle, registry

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(proofs):
            beside = at[i] ^ 1
            p.append((at[i] % 2, nodes[beside]) if beside < len(nodes) else (0, ""))
            at[i] //= 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def by_hand(rows):
    groups = {}
    for r in rows:
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        leaf = digest(*map(field, values))
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and values[3] is not None:
            values[3] += 1
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf, digest(*map(field, values))))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[k] = tree([x[1] for x in groups[k]])
    root, over = tree([trees[k][0] for k in keys])
    out = []
    for k, upper in zip(keys, over, strict=True):
        for (doc_id, leaf, now), lower in zip(groups[k], trees[k][1], strict=True):
            for left, s in lower + upper:
                now = digest(s, now) if left else digest(now, s)
            out.append((doc_id, leaf, trees[k][0], root, digest(*[s for _, s in lower + upper]), now, now == root))
    return sorted(out, key=str)


def by_spark(docs):
    found = merkle.manifest(docs, changed={"n_chars": F.col("n_chars") + 1}, suspect=merkle.tampered(F.col("doc_id")))
    return sorted((tuple(r) for r in found.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_query_equals_a_tree_built_by_hand(spark, sf):
    got = registry.QUERIES["op11_merkle_manifest"](spark, sf)
    want = by_hand(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


def test_query_equals_its_sql(same):
    same(registry.QUERIES["op11_merkle_manifest"], registry.SQL["op11_merkle_manifest"])


def test_group_sizes_around_a_run(spark):
    rows = [(1000 * n + i, "s", f"of {n}" if n else None, i, f"text {i}") for n in (0, 1, 2, 3, 255, 256, 257, 513) for i in range(n or 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert by_spark(docs) == by_hand(docs.collect())


def test_trees_of_several_persisted_tables(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 2)
    monkeypatch.setattr(merkle, "RUN", 4)
    rows = [(i, "s", f"g{i % 23}" if i % 3 else "hot", i, f"text {i}") for i in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert by_spark(docs) == by_hand(docs.collect())


def test_nulls_empties_long_texts_and_repeats(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (7, "s", "ä", 3, "äß𝄞"), (7, "s", "z", None, "x"),
        (21, "s", "z", 5, "long " * 300_000), (-4, "s", "z", 2, "1:2"), (3, "s", None, 1, "y"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert by_spark(docs) == by_hand(docs.collect())


def test_any_tampering_is_found_and_nothing_else(spark):
    docs = spark.createDataFrame([(i, "s", "ab"[i % 2], 1, "t") for i in range(40)], SCHEMA)
    found = {r["id"]: r["verified"] for r in merkle.manifest(docs, changed={"text": F.lit("u")}, suspect=F.col("doc_id").isin(3, 8)).collect()}
    assert {i for i, ok in found.items() if not ok} == {3, 8}
    assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).count() == 0
    docs = spark.createDataFrame([(i, "s", "a", 1, "t") for i in range(5)], SCHEMA)
    more = docs.withColumns({c: F.lit(9) for c in ("g", "pos", "h", "n", "run", "items", "levels", "suffix", "leaf", "root", "id", "grp", "item", "later", "_part")})
    assert by_spark(more) == by_spark(docs)
    assert merkle.manifest(more).columns == merkle.manifest(empty).columns
