"""Near duplicates among embeddings of one label: tiles compared along principal axes, leading ones first.

Exact copies are one class, so a group of copies is one row from the start.  Unit vectors are turned to their
principal axes (of second moments, for cosines are taken from the origin), found over all rows by streaming moments.
A label's classes stand in the order of their first coordinate and are cut into blocks of bounded size.  Two unit vectors
with a cosine of at least t are at most sqrt(2 - 2 t) apart, in each coordinate too, so only blocks whose ranges
of the first coordinate come that near meet; a task compares one pair of blocks, tile by tile.

In a tile products of the leading coordinates are accumulated, 8, 16, 32 ... of them; what the rest can add is at most the
product of the two suffix norms.  A tile is left as soon as no pair of it can reach the threshold, and rows
and columns without such a pair leave before.  Pairs that remain are measured by their original vectors in
double precision, so the turned ones, which are rounded, only leave out what is below the threshold by more than SLACK.

A task returns for each vector how many it links with and a spanning tree, no pairs.  Links are
exact and whole.  The work is that of the method: it grows with the square of a label's distinct vectors, cut by
the ranges; each block is sent once to each block that it meets.  Blocks grow with the label up to BLOCK_BYTES, so the rows
that are sent grow faster than the input only where a label has more than PARTS such blocks.

Nulls: a row without a label, without a vector, with an empty or zero vector or one that holds a null, a NaN or an
infinity links with nothing.  Vectors of different length never link.  A null id stands for no id: such a row is
counted as another vector, its component_id is the smallest id that it reaches, and is null if there is none.  Rows that
repeat an id are vectors of their own, and component ids are the smallest among all.  An empty table gives an empty
result.  Other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from .blocks import tidy
from .common import drop_written, small_side, table, written
from .jaccard_join import components
from .vectors import common_length, matrix, moments, symmetric_eigen

THRESHOLD = 0.98
#: Blocks that a label is cut into while they stay within the bounds below.
PARTS = 8
BLOCK_ROWS, BLOCK_BYTES = 512, 16 << 20
TILE = 512
LEADING = 8
SLACK = 1e-9
#: Pairs of a tile that are measured one by one.
PAIRS = 4096
#: Ranges of the first coordinate that blocks are put together from.
RANGES = 400


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest entry is taken out first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def suffix_norms(z: np.ndarray, ends: list[int]) -> np.ndarray:
    """A column for each end: the length of what comes after that coordinate."""
    squares = np.cumsum((z * z)[:, ::-1], 1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(z), 1))], 1)
    return np.sqrt(squares[:, ends])


def stops(d: int) -> list[int]:
    """Where the accumulation looks at its bound: LEADING coordinates, twice as many, and so on to d."""
    out, k = [], LEADING
    while k < d:
        out.append(k)
        k *= 2
    return [*out, d]


def tile_pairs(a: np.ndarray, b: np.ndarray, sa: np.ndarray, sb: np.ndarray, ends: list[int], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (row of a, row of b) of the pairs whose product may reach `least`."""
    rows, cols = np.arange(len(a)), np.arange(len(b))
    acc, lo = np.zeros((len(a), len(b))), 0
    for i, hi in enumerate(ends):
        acc += a[rows, lo:hi] @ b[cols, lo:hi].T
        able = acc + np.outer(sa[rows, i], sb[cols, i]) >= least
        lo = hi
        if hi == ends[-1]:
            break
        r, c = able.any(1), able.any(0)
        if not r.any():
            return rows[:0], cols[:0]
        if not (r.all() and c.all()):
            rows, cols, acc = rows[r], cols[c], acc[np.ix_(r, c)]
    i, j = np.nonzero(able)
    return rows[i], cols[j]


class Forest:
    """Links among the rows of a task, joined as they come."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j = i[open_], j[open_]
            # Each larger root takes the smallest root that it is linked with, then paths are followed to their ends.
            np.minimum.at(self.root, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def compared(x: np.ndarray, side: np.ndarray, copies: np.ndarray, axes: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each row: other vectors that it links with, by number of copies, and a row of its component.

    side: 0 for rows of a block, 1 for those of the block that it meets; rows of side 0 alone are compared with each other.
    """
    x = x / np.abs(x).max(1, keepdims=True)
    length = np.sqrt((x * x).sum(1))
    z = (x / length[:, None]) @ axes.T
    ends = stops(x.shape[1])
    norms = suffix_norms(z, ends)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(second)
    if alone:
        second = first
    links, forest = np.zeros(len(x), np.int64), Forest(len(x))
    reach = np.sqrt(max(2 - 2 * threshold, 0)) + SLACK
    # Tiles are cut in order of the first coordinate, so most that can't meet are left without a product.
    first, second = (p[np.argsort(z[p, 0], kind="stable")] for p in (first, second))
    for lo in range(0, len(first), TILE):
        p = first[lo : lo + TILE]
        for at in range(lo if alone else 0, len(second), TILE):
            q = second[at : at + TILE]
            if z[q[0], 0] - z[p[-1], 0] > reach:
                break
            if z[p[0], 0] - z[q[-1], 0] > reach:
                continue
            i, j = tile_pairs(z[p], z[q], norms[p], norms[q], ends, threshold - SLACK)
            if alone and at == lo:
                i, j = i[i < j], j[i < j]
            if len(i) > PAIRS:  # a tile of near copies: one product instead of its pairs
                linked = (x[p] @ x[q].T) / np.outer(length[p], length[q]) >= threshold
                i, j = np.nonzero(np.triu(linked, 1) if alone and at == lo else linked)
            else:
                linked = (x[p[i]] * x[q[j]]).sum(1) / (length[p[i]] * length[q[j]]) >= threshold
                i, j = i[linked], j[linked]
            # Doubles hold the counts of a tile exactly.
            links += np.bincount(p[i], copies[q[j]], len(x)).astype(np.int64) + np.bincount(q[j], copies[p[i]], len(x)).astype(np.int64)
            forest.join(p[i], q[j])
    return links, forest.root


def turned(classes: DataFrame, d: int) -> np.ndarray:
    """Principal axes of the second moments of all unit vectors of d entries, as rows, the longest first."""
    found, _ = moments(classes.select("v"), d, lambda batch: unit(matrix(batch.column(0), d)[1]))
    return symmetric_eigen(found.covariance() + np.outer(found.mean, found.mean))[1] if found.n else np.eye(d)


def _first_coordinates(classes: DataFrame, axes: np.ndarray) -> DataFrame:
    """(cid, label, d, m, first_id, v, z): z is the first coordinate; of vectors of another length than the axes, their own first entry."""
    d, axis = len(axes), axes[0] if len(axes) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.zeros(batch.num_rows)
            for size in set(batch.column("d").to_pylist()):
                at, x = matrix(batch.column("v"), size)
                x = unit(x)
                z[at] = x @ axis if size == d else x[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z)], [*batch.schema.names, "z"])

    kinds = ", ".join(f"{c} {t}" for c, t in classes.dtypes)
    return classes.mapInArrow(tidy(run), f"{kinds}, z double")


def _blocks(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """rows (label, d, z, bin, ...) with the block `at` that each is in, and (label, d, at, tasks): the pairs of blocks that meet, by block.

    Blocks are runs of ranges of z; a range that holds more than a block's rows is dealt by a hash.
    """
    group = W.partitionBy("label", "d").orderBy("bin")
    most = F.least(F.greatest(F.lit(BLOCK_ROWS), F.ceil(F.col("all") / PARTS)), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("d")))))
    bins = rows.groupBy("label", "d", "bin").agg(F.count("*").alias("n"))
    size = bins.groupBy(F.col("label").alias("_l"), F.col("d").alias("_d")).agg(F.sum("n").alias("all"))
    bins = bins.join(size, (F.col("label") == F.col("_l")) & (F.col("d") == F.col("_d"))).drop("_l", "_d").withColumn("most", most)
    bins = bins.withColumn("before", F.sum("n").over(group) - F.col("n"))
    bins = bins.select("label", "d", "bin", F.floor(F.col("before") / F.col("most")).alias("block"), F.ceil(F.col("n") / F.col("most")).cast("int").alias("splits"))
    bins = small_side(bins, "vector-bins")
    salt = F.pmod(F.xxhash64("cid"), F.col("splits")).cast("int")
    placed = written(rows.join(bins, ["label", "d", "bin"]).withColumn("at", F.struct("block", salt.alias("split"))).drop("bin", "block", "splits"), "vector-blocks")
    ends = small_side(placed.groupBy("label", "d", "at").agg(F.min("z").alias("lo"), F.max("z").alias("hi")), "vector-ends")
    a, b = (ends.select("label", "d", *[F.col(c).alias(f"{s}_{c}") for c in ("at", "lo", "hi")]) for s in "ab")
    reach = float(np.sqrt(max(2 - 2 * threshold, 0)) + SLACK)
    meets = a.join(b, ["label", "d"]).filter((F.col("a_at") <= F.col("b_at")) & (F.col("b_lo") - F.col("a_hi") <= reach) & (F.col("a_lo") - F.col("b_hi") <= reach))
    roles = F.when(F.col("a_at") == F.col("b_at"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    meets = meets.select("label", "d", "a_at", "b_at", F.explode(roles).alias("side"))
    meets = meets.select("label", "d", "a_at", "b_at", "side", F.when(F.col("side") == 0, F.col("a_at")).otherwise(F.col("b_at")).alias("at"))
    tasks = small_side(meets.groupBy("label", "d", "at").agg(F.collect_list(F.struct("a_at", "b_at", "side")).alias("tasks")), "vector-tasks")
    return placed, tasks


def _found(rows: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """rows (task, side, cid, d, m, v), a task's rows one after another: (cid, links, root) of those that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            one = pa.Table.from_batches(parts)
            side, cid, m = (one.column(c).to_numpy() for c in ("side", "cid", "m"))
            _, x = matrix(one.column("v"), one.column("d")[0].as_py())
            links, root = compared(x, side, m, axes if x.shape[1] == len(axes) else np.eye(x.shape[1]), threshold)
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(links[at]), pa.array(cid[root[at]])], ["cid", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("task").dictionary_encode()
            at = codes.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts, cuts[1:]):
                if (own := codes.dictionary[int(at[lo])].as_py()) != name:
                    yield from done()
                    name, parts = own, []
                parts.append(batch.slice(lo, hi - lo))
        yield from done()

    return rows.mapInArrow(tidy(run), "cid long, links long, root long")


def vector_components(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept), a row for each row of rows.  threshold: above 0."""
    # A bound of the largest entry says of all entries that they are finite: NaN is the largest of all.
    v = F.col("v")
    largest = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    whole = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull()) & (largest > 0) & (largest < float("inf"))
    base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    base = base.withColumn("d", F.when(whole, F.size("v")))
    h = [F.xxhash64(F.lit(i), "label", "v") for i in range(2)]
    h = [F.when(F.col("d").isNotNull(), x) for x in h]
    keyed = written(base.select("id", h[0].alias("h1"), h[1].alias("h2")), "vector-keys")
    classes = base.filter("d is not null").groupBy("label", "d", "v").agg(F.min("id").alias("first_id"), F.count("*").alias("m"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    d = common_length(classes, "v")
    axes = turned(classes, d) if d else np.eye(1)
    bin_ = F.floor((F.col("z") + 1) * (RANGES / 2)).cast("int").alias("bin")
    blocks, tasks = _blocks(_first_coordinates(classes.select("cid", "label", "d", "m", "v"), axes).select("*", bin_), threshold)
    dealt = blocks.join(tasks, ["label", "d", "at"]).select("label", "d", F.explode("tasks").alias("t"), "cid", "m", "v")
    name = F.concat_ws("/", F.col("label").cast("string"), *[F.col(c) for c in ("d", "t.a_at.block", "t.a_at.split", "t.b_at.block", "t.b_at.split")])
    dealt = dealt.select(name.alias("task"), "t.side", "cid", "d", "m", "v").repartition("task").sortWithinPartitions("task", "side", "cid")
    found = written(_found(dealt, axes, threshold), "vector-links")

    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("cid", "label", "v", "m", "first_id").join(sums, "cid", "left").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    h = [F.xxhash64(F.lit(i), "label", "v") for i in range(2)]
    # Written, so that the last join is one of two plain exchanges, whose hot partitions Spark splits.
    result = written(named.join(least, "root").select(h[0].alias("h1"), h[1].alias("h2"), (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-result")
    for df in (classes, blocks, found):
        drop_written(df)
    out = keyed.join(result, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull() | F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_components(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


#: Every pair of a label is measured, and labels spread along links.
OP13_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b)
SELECT x.vec_id, (SELECT count(*) FROM e WHERE e.a = x.vec_id) AS n_links, m.component_id, x.vec_id = m.component_id AS kept
FROM embeddings x JOIN (SELECT id, min(root) AS component_id FROM r GROUP BY id) m ON m.id = x.vec_id
"""
