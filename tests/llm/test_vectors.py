"""Whitening and near duplicates of embeddings against numpy over all rows, and their edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import registry, vector_dedup as vd, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def whitened_by_hand(rows, k=8):
    """{(id, place of the row): (n, deviation, whitened, explained)} by one covariance of all rows."""
    have = [(r["vec_id"], r["embedding"]) for r in rows if usable(r["embedding"])]
    x = np.floor(1024.0 * np.array([v for _, v in have], float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    centred = (n * x - s).astype(float) / n
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return have, n, [sum(int(a) ** 2 for a in n * row.astype(object) - s) for row in x], centred @ q / np.sqrt(e), e / np.trace(cov)


def check_whitening(got, rows):
    have, n, deviation, want, explained = whitened_by_hand(rows)
    k = want.shape[1]
    assert len(got) == len(have) * k and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for j in range(k):
        pairs = []
        for i in {i for i, _ in have}:
            mine = sorted((d, w) for (h, _), d, w in zip(have, deviation, want[:, j], strict=True) if h == i)
            rows_ = sorted(by[(i, j + 1)], key=lambda r: (r["deviation"], r["whitened"]))
            assert sorted(int(r["deviation"]) for r in rows_) == [d for d, _ in mine]
            if len(mine) == 1:
                pairs.append((rows_[0]["whitened"], mine[0][1]))
        a, b = np.array(pairs).T
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 for r in got)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_query(spark, sf):
    check_whitening(registry.QUERIES["op12_embedding_whitening"](spark, sf).collect(), spark.read.parquet(f"{sf}/embeddings.parquet").collect())


def test_whitening_drops_what_is_not_a_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * np.linspace(1, 4, 12) + 3).tolist(), 1) for i in range(300)]
    rows += [(3, rows[3][1], None), (None, rows[4][1], 2), (900, None, 1), (901, [], 1), (902, [None] + [1.0] * 11, 1), (903, [float("nan")] * 12, 1), (904, [float("inf")] + [0.0] * 11, 1)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"n": F.lit("x"), "component": F.lit(None), "v": F.lit(0), "id": F.lit(1)})
    got = whitening.whiten(table).withColumnRenamed("id", "vec_id").collect()
    assert {r["vec_id"] for r in got} == {*range(300), None}
    check_whitening([r for r in got], table.collect())


def test_whitening_without_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], SCHEMA)).collect()
    assert [(r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(c, 1, 0, None, 0.0, 0.0) for c in (1, 2, 3)]
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 1) for i in range(50)], SCHEMA)).collect()
    assert {r["component"] for r in line if r["whitened"] is not None} == {1} and line[0]["identity_error"] < 1e-9


def test_deviation_of_any_size_is_exact(spark):
    rows = [(i, [(-1.0) ** i * 2.0**40, float(i)], 1) for i in range(9)]
    got = {r["id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    x = [[int(math.floor(1024 * c)) + 100_000 for c in v] for _, v, _ in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: sum((9 * a - t) ** 2 for a, t in zip(x[i], total, strict=True)) for i in range(9)}
    wild = whitening.whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert len(wild) == 4


def test_moments_merge_and_eigenvectors():
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 17, 64):
        x = rng.normal(size=(5000, d)) * np.linspace(1, 2, d) + 1e5
        whole, parts = vectors.Moments(d), vectors.Moments(d)
        whole.add(x)
        for lo, hi in ((0, 1), (1, 1), (1, 700), (700, 5000)):
            part = vectors.Moments(d)
            for k in range(lo, hi, 333):
                part.add(x[k : min(k + 333, hi)])
            parts.merge(part.n, part.mean, part.m2)
        want = np.cov(x.T, bias=True).reshape(d, d)
        assert np.allclose(whole.covariance(), want, rtol=1e-9, atol=1e-9) and np.allclose(parts.covariance(), want, rtol=1e-9, atol=1e-9)
        e, q = vectors.symmetric_eigen(want)
        assert (np.diff(e) <= 0).all() and np.allclose(q @ q.T, np.eye(d), atol=1e-12) and np.allclose(q @ want @ q.T, np.diag(e), atol=1e-11)
    assert vectors.symmetric_eigen(np.zeros((2, 2)))[0].tolist() == [0, 0]


# ---- near duplicates ----------------------------------------------------------------------------


def links_by_hand(rows, threshold=0.98):
    rows = [tuple(r) for r in rows]
    fit = [i for i, (_, v, label) in enumerate(rows) if label is not None and usable(v) and any(v)]
    partner = {i: set() for i in range(len(rows))}
    for a in fit:
        for b in fit:
            u, v = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and rows[a][2] == rows[b][2] and len(u) == len(v):
                u, v = u / np.abs(u).max(), v / np.abs(v).max()
                if u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= threshold:
                    partner[a].add(b)
                    partner[b].add(a)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for b in partner[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        root = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(partner[i]), root, r[0] == root))
    return sorted(out, key=str)


def links(table, **options):
    return sorted((tuple(r) for r in vd.vector_components(table, **options).collect()), key=str)


def near(rng, v, angle):
    w = rng.normal(size=len(v))
    w -= w @ v * v / (v @ v)
    return np.cos(angle) * v / np.linalg.norm(v) + np.sin(angle) * w / np.linalg.norm(w)


def planted(rng, d=16, n=240):
    """Copies, near copies, chains of links and scaled vectors among vectors of their own."""
    rows = [(rng.normal(size=d) * np.linspace(2, 0.5, d)).tolist() for _ in range(n // 3)]
    while len(rows) < n:
        base = np.array(rows[rng.integers(len(rows))])
        rows.append([base, base * rng.uniform(0.1, 9), near(rng, base, rng.uniform(0, 0.25)), near(rng, base, 0.19)][rng.integers(4)].tolist())
    return [(i, np.float32(v).tolist(), int(rng.integers(3))) for i, v in enumerate(rows)]


@pytest.mark.parametrize("small", [False, True])
def test_links_of_planted_groups(spark, monkeypatch, small):
    if small:  # several blocks a label, several tiles a block, ranges that are split
        for name, value in (("BLOCK_ROWS", 16), ("TILE", 4), ("PAIRS", 5), ("RANGES", 6), ("LEADING", 2)):
            monkeypatch.setattr(vd, name, value)
    rows = planted(np.random.default_rng(5))
    want = links_by_hand(rows)
    assert sum(not w[3] for w in want) > 60 and sum(w[1] == 0 for w in want) > 20
    assert links(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want


def test_a_large_group_of_copies_and_one_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(vd, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(6)
    base = rng.normal(size=8)
    rows = [(i, [0.5] * 8, 1) for i in range(400)] + [(1000 + i, near(rng, base, rng.uniform(0, 0.15)).tolist(), 1) for i in range(300)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    got = {r["id"]: r for r in vd.vector_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {w[0]: w for w in links_by_hand(rows[400:])}
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (399, 0, i == 0) for i in range(400))
    assert all((got[i]["n_links"], got[i]["component_id"]) == want[i][1:3] for i in range(1000, 1300))


def test_rows_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, [1.0, 0.0], None), (4, None, 1), (5, None, 1), (6, [0.0, -0.0], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1),
        (11, [inf, 1.0], 1), (12, [None, 1.0], 1), (13, [None, 1.0], 1), (14, [], 1), (15, [], 1), (16, [1.0, 0.0, 0.0], 1), (17, [1.0, 0.0], 2), (18, [-1.0, 0.0], 1), (19, [3.0, -0.0], 1), (20, [1e-30, 0.0], 1),
        (None, [5.0, 0.0], 1), (None, [0.0, 1.0], 3), (None, None, 3), (21, [0.0, 7.0], 3), (22, [3e38, 3e38], 4), (23, [1e38, 1e38], 4), (24, [1e-45, 1e-45], 4), (17, [1.0, 0.0], 2), (1, [0.0, 2.0], 3),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    want = links_by_hand(rows)
    assert links(table) == [(*w[:3], w[0] == w[2]) for w in want]
    clash = table.withColumns({c: F.lit("x") for c in ("id", "v", "d", "m", "cid", "h1", "h2", "task", "side", "root", "links", "first_id", "n_links", "component_id", "kept", "at", "block")})
    assert links(clash) == links(table)
    assert vd.vector_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert links(spark.createDataFrame([(1, None, 1)], SCHEMA)) == [(1, 0, 1, True)]


def test_a_tile_is_left_when_its_bound_is_below(monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(64, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ends = vd.stops(64)
    assert ends == [8, 16, 32, 64] and vd.stops(5) == [5] and vd.stops(8) == [8]
    norms = vd.suffix_norms(x, ends)
    assert np.allclose(norms[:, -1], 0) and np.allclose(norms[:, 0], np.linalg.norm(x[:, 8:], axis=1))
    for least in (0.2, 0.5, 0.98):
        i, j = vd.tile_pairs(x[:32], x[32:], norms[:32], norms[32:], ends, least)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(x[:32] @ x[32:].T >= least)), strict=True))


def test_dedup_query_equals_its_sql(same):
    same(registry.QUERIES["op13_vector_dedup"], registry.SQL["op13_vector_dedup"])
