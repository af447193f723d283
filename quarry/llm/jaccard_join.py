"""Exact n-gram Jaccard self-join: connected components of documents with similar shingle sets.

1. Every text becomes the set of its distinct 5-word shingles, as 64-bit hashes.  A set
   is known by its size and a 128-bit signature; equal sets form one class, so copies
   are searched once.  Its representative is the smallest id.
2. In a fixed order of all shingles, two sets of the required similarity share one among
   the first n - ceil(0.8 n) + 1 of each.  Any order is exact.  Ours is by hash, but
   shingles that a bounded frequency sketch over all texts finds common come last, which
   keeps the inverted lists of the prefixes short.
3. An inverted list, in order of set size, is cut where no pair across is of the required
   similarity, given the sizes and the places of the shingle in the sets.  The first
   document of such a group is its hub; every document of the group goes to the block of
   the hub, once for all lists of that hub.  Whatever shares a group shares a block, so no
   pair is missed, and rows grow with prefixes, not with pairs.
   Members that differ from each other one of their block in more places of a parity sketch than similar sets
   can leave before texts are read; no similar pair does (possible()).
4. A block is searched with T-occurrence queries (DivideSkip): the longest lists of a
   query are set aside and probed by binary search, the short ones are merged with a heap
   that skips, and documents on enough lists are retained; the similarity test on their
   exact overlap follows.  Pairs that are connected already are not searched again.
5. Blocks of more than ``BLOCK`` documents are dealt into chunks, each with the hub; then
   documents outside the largest component of their block are queried against the other
   chunks.  A group of near copies is one component by then and costs nothing more.
6. Components of the links found by large-star / small-star rounds on tables.

Nulls and texts without words have an empty set and are linked with nothing; a null id
takes part in no link and has a null component unless its set equals that of another
row.  Rows that repeat an id are judged each by its own text but are one node.  Very long texts
are sets as a whole; of sets that tie on size the smaller id comes first.  An empty table gives an
empty result.  Ids are numbers, or text that is one: other text ends the job with a cast error.  Other columns are not read; one_of_each keeps them, whatever their names.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .blocks import blocks, mix, shingle_sets, tidy, U
from .common import drop_written, fresh, small_side, table, written

SHINGLE = 5
#: Similarity: NUM * union <= DEN * intersection.
NUM, DEN = 80, 100
#: Documents of a block that one chunk holds.
BLOCK = 512
#: Counters of the frequency sketch, in a task and in all; they bear on speed alone.
SKETCH, SKETCH_KEPT, SKETCH_LEAST = 4096, 32_768, 32
#: DivideSkip's weight of a probe against a step of the merge.
MU = 0.02
#: Bits of a set's parity sketch: each counts, modulo 2, the shingles that hash to it.
BITS = 1024
#: Rows of a hub that sketches are compared of; of more, all stay.
SKETCHED = 1 << 14
SALTS = (U(0), U(0x5851F42D4C957F2D))


def least_overlap(n: int, m: int) -> int:
    """The smallest intersection with which sets of n and m are similar."""
    return -(-NUM * (n + m) // (NUM + DEN))


def t_occurrence(lists: list[list[int]], t: int) -> dict[int, int]:
    """Numbers that are on t lists or more (sorted lists of distinct numbers), with how many they are on.  DivideSkip."""
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < t or t < 1:
        return {}
    n_long = min(t - 1, int(t / (MU * log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    need = t - n_long
    heap = [(x[0], i) for i, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)
    found: dict[int, int] = {}
    while len(heap) >= need:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            n = len(popped)
            for left, x in zip(range(len(long), 0, -1), reversed(long), strict=True):
                if n + left < t:
                    break
                j = bisect_left(x, top)
                n += j < len(x) and x[j] == top
            if n >= t:
                found[top] = n
            for i in popped:
                at[i] += 1
                if at[i] < len(short[i]):
                    heapq.heappush(heap, (short[i][at[i]], i))
        else:
            # Skip: nothing below the need-th smallest head can be on enough short lists.
            while len(popped) < need - 1 and heap:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            head = heap[0][0]
            for i in popped:
                at[i] = bisect_left(short[i], head, at[i])
                if at[i] < len(short[i]):
                    heapq.heappush(heap, (short[i][at[i]], i))
    return found


class Components:
    def __init__(self, n: int):
        self.up, self.size, self.parts = list(range(n)), [1] * n, n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        if self.size[i] < self.size[j]:
            i, j = j, i
        self.up[j], self.size[i] = i, self.size[i] + self.size[j]
        self.parts -= 1
        return True


def search(sets: list[np.ndarray], is_query: list[bool], is_index: list[bool], labels: list[int]) -> list[tuple[int, int]]:
    """Links that connect what is similar among the queries and the indexed sets, none twice connected.

    labels: what is connected beforehand has equal ones.  Every set that is a query is searched
    unless all it could be linked with is connected to it.
    """
    n = len(sets)
    parts, links = Components(n), []
    first: dict[int, int] = {}
    for i, label in enumerate(labels):
        parts.join(i, first.setdefault(label, i))
    if parts.parts < 2:
        return links
    size = np.array([len(s) for s in sets])
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    number = np.cumsum(new) - 1  # of each posting's list
    in_index = np.array(is_index)[owner]
    n_lists = int(number[-1]) + 1
    length = np.bincount(number[in_index], minlength=n_lists)
    begin = np.concatenate([[0], np.cumsum(length)])
    posted = owner[in_index]
    # Lists of one set can only hold the query itself.
    by_owner = np.argsort(owner, kind="stable")
    lists_of = np.split(number[by_owner], np.cumsum(np.bincount(owner, minlength=n))[:-1])
    cache: dict[int, list[int]] = {}
    sizes = size.tolist()

    def run(q: int) -> None:
        mine = lists_of[q]
        least = 2 if is_index[q] else 1
        mine = mine[length[mine] >= least]
        t = least_overlap(sizes[q], -(-NUM * sizes[q] // DEN))
        if len(mine) < t:
            return
        got = []
        for k in mine.tolist():
            x = cache.get(k)
            if x is None:
                x = cache[k] = posted[begin[k] : begin[k + 1]].tolist()
            got.append(x)
        for other, common in t_occurrence(got, t).items():
            if other != q and DEN * common >= NUM * (sizes[q] + sizes[other] - common) and parts.join(q, other):
                links.append((q, other))

    queries = [i for i in range(n) if is_query[i]]
    for k, q in enumerate(queries):
        if parts.parts < 2:
            break
        root = parts.root(q)
        # After the first query most of a block is one component; its members are left out,
        # for whatever else is linked with them is a query itself.
        if k and parts.size[root] * 2 > n and all(is_query[i] or parts.root(i) == root for i in range(n)):
            continue
        run(q)
    return links


# ---- tables -------------------------------------------------------------------------------------


def common_shingles(docs: DataFrame, text_col: str) -> np.ndarray:
    """Hashes of the shingles that a Misra-Gries sketch over all texts finds most often, least often first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, n = np.zeros(0, U), np.zeros(0, np.int64)
        for batch in batches:
            for b in blocks(batch.column(0)):
                g, _ = shingle_sets(b, SHINGLE)
                u, c = np.unique(g, return_counts=True)
                twice = c > 1
                known = np.isin(u, token, assume_unique=True)
                u, c = u[twice | known], c[twice | known]
                token, where = np.unique(np.concatenate([token, u]), return_inverse=True)
                n = np.bincount(where, np.concatenate([n, c]), len(token)).astype(np.int64)
                if len(token) > 4 * SKETCH:
                    top = np.argpartition(n, len(n) - SKETCH)[-SKETCH:]
                    token, n = token[top], n[top]
        top = np.argsort(n)[-SKETCH:]
        top = top[n[top] >= 4]
        yield pa.RecordBatch.from_arrays([pa.array(token[top].view(np.int64)), pa.array(n[top])], ["token", "n"])

    found = docs.select(text_col).mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= SKETCH_LEAST)
    rows = found.orderBy(F.desc("n"), "token").limit(SKETCH_KEPT).collect()
    return np.array([r["token"] for r in reversed(rows)], np.int64).view(U)


def shingled(docs: DataFrame, id_col: str, text_col: str, last: np.ndarray) -> DataFrame:
    """(id, n, h1, h2, prefix, bits): set size, signature, the prefix in the order of shingles and the parity sketch."""
    sorted_last = np.sort(last)
    rank = np.argsort(last).astype(U) if len(last) else last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(1)):
                g, n = shingle_sets(b, SHINGLE)
                doc = np.repeat(np.arange(b.n), n)
                stops = np.cumsum(n)
                h1, h2 = (np.diff(np.concatenate([[U(0)], np.cumsum(mix(g ^ salt))])[np.concatenate([[0], stops])]) for salt in SALTS)
                key = g >> U(1)
                if len(sorted_last):
                    at = np.minimum(np.searchsorted(sorted_last, g), len(sorted_last) - 1)
                    hit = sorted_last[at] == g
                    key = np.where(hit, rank[at] | U(1 << 63), key)
                order = np.lexsort((key, doc))
                length = np.where(n > 0, n - -(-NUM * n // DEN) + 1, 0)
                place = np.arange(len(g)) - np.repeat(stops - n, n)
                kept = order[place < np.repeat(length, n)]
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(g[kept].view(np.int64)))
                bits = pa.Array.from_buffers(pa.binary(), b.n, [None, pa.py_buffer(np.arange(b.n + 1, dtype=np.int32) * (BITS // 8)), pa.py_buffer(parities(g, doc, b.n))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b.lo, b.n), pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), prefix, bits], ["id", "n", "h1", "h2", "prefix", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(tidy(run), "id long, n long, h1 long, h2 long, prefix array<long>, bits binary")


def parities(g: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """BITS bits of each of n documents: which bits an odd number of its shingles g hash to."""
    at = np.sort(doc * BITS + (mix(g ^ U(0xB175)) % U(BITS)).astype(np.int64))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    odd = np.zeros(n * BITS, bool)
    odd[at[first[np.diff(np.append(first, len(at))) % 2 == 1]]] = True
    return np.packbits(odd)


def able(n: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which sets can be similar to another one, given sizes and sketches (rows of 64-bit words).

    Sketches differ in as many bits as the sets in shingles, or fewer.
    """
    out = np.zeros(len(n), bool)
    rows = max(1, (1 << 17) // max(1, len(n)))
    for lo in range(0, len(n), rows):
        both = n[lo : lo + rows, None] + n[None, :]
        apart = np.bitwise_count(bits[lo : lo + rows, None, :] ^ bits[None, :, :]).sum(2, dtype=np.int64)
        fits = apart <= both - 2 * -(-NUM * both // (NUM + DEN))
        fits[np.arange(len(fits)), lo + np.arange(len(fits))] = False
        out[lo : lo + rows] = fits.any(1)
    return out


def possible(rows: DataFrame) -> DataFrame:
    """(hub, id) of rows (hub, id, n, bits), a hub's one after another, that can be similar to another row of their hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub0, parts, held, every = None, [], 0, False

        def out(all_: bool) -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            rid, n, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
            rid = rid if all_ else rid[able(n, bits)]
            if len(rid):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rid), hub0, np.int64)), pa.array(rid)], ["hub", "id"])
            parts.clear()

        for batch in batches:
            if not len(batch):
                continue
            hub, rid, n = (batch.column(i).to_numpy() for i in range(3))
            column = batch.column(3).cast(pa.binary())
            at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            bits = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(column), -1).copy().view(U)
            edges = np.concatenate([[0], np.flatnonzero(hub[1:] != hub[:-1]) + 1, [len(hub)]]).tolist()
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hub[lo] != hub0:
                    yield from out(every)
                    hub0, held, every = hub[lo], 0, False
                parts.append((rid[lo:hi], n[lo:hi], bits[lo:hi]))
                held += hi - lo
                if held > SKETCHED:
                    every = True
                    yield from out(True)
        yield from out(every)

    return rows.mapInArrow(tidy(run), "hub long, id long")


def hubs(postings: DataFrame) -> DataFrame:
    """(hub, id) of the groups of each inverted list; postings(token, id, n, most) come sorted by token, n, id.

    most: the largest set that the posting's document can be similar to if this is the first shingle
    they share.  Where a size exceeds `most` of all before it in its list, no pair spans that place, so
    the list is cut there; a posting whose `most` is below its group's smallest size has no partner.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token0 = hub0 = first0 = most0 = None
        for batch in batches:
            token, rid, n, most = (batch.column(i).to_numpy().astype(np.int64) for i in range(4))
            if not len(token):
                continue
            # The list that the last batch ended in goes on from what is known of it.
            goes_on = token0 is not None and token[0] == token0
            if goes_on:
                token, rid, n, most = (np.concatenate([[x], y]) for x, y in ((token0, token), (hub0, rid), (first0, n), (most0, most)))
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            lists = np.cumsum(new)
            reach = np.maximum.accumulate((lists << 32) + most) & 0xFFFFFFFF
            cut = new.copy()
            cut[1:] |= n[1:] > reach[:-1]
            first = np.maximum.accumulate(np.where(cut, np.arange(len(token)), 0))
            hub, least = rid[first], n[first]
            token0, hub0, first0, most0 = token[-1], hub[-1], least[-1], reach[-1]
            pair = np.flatnonzero((hub != rid) & (most >= least))
            if len(pair):
                p = np.unique(np.stack([hub[pair], rid[pair]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["hub", "id"])

    return postings.mapInArrow(tidy(run), "hub long, id long").distinct()


def found_links(rows: DataFrame) -> DataFrame:
    """rows: (hub, chunk, id, role, label, text), a group's rows one after another.

    role 0 is query and index, 1 index only, 2 query only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def done():
            if len(group) < 2:
                return None
            ids, sets, role = [g[0] for g in group], [g[3] for g in group], [g[1] for g in group]
            links = search(sets, [r != 1 for r in role], [r != 2 for r in role], [g[2] for g in group])
            return [(ids[a], ids[b]) for a, b in links if ids[a] != ids[b]] or None

        for batch in batches:
            out = []
            hub, chunk, rid, role, label = (batch.column(i).to_pylist() for i in range(5))
            for b in blocks(batch.column(5)):
                g, n = shingle_sets(b, SHINGLE)
                for j, s in zip(range(b.lo, b.hi), np.split(g, np.cumsum(n)[:-1]), strict=True):
                    if (hub[j], chunk[j]) != key:
                        out += done() or []
                        key, group = (hub[j], chunk[j]), []
                    if len(s):
                        group.append((rid[j], role[j], label[j], s.copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["u", "v"])
        if out := done():
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["u", "v"])

    return rows.mapInArrow(tidy(run), "u long, v long")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root): each linked node and the smallest of its component.  Large-star and small-star in turn."""
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["k"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, large["u"] == least["k"]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        new = written(small.filter("u != v").distinct(), "edges")
        state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        drop_written(edges)
        edges = new
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), a row for each row of docs."""
    spark = docs.sparkSession
    sets = written(shingled(docs, id_col, text_col, common_shingles(docs, text_col)), "sets")
    classes = sets.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("id"), F.first("prefix").alias("prefix")).filter("id is not null")
    most = F.floor((F.col("n") - F.col("pos")) * ((NUM + DEN) / NUM)) - F.col("n")
    postings = classes.select(F.posexplode("prefix").alias("pos", "token"), "id", "n").select("token", "id", F.col("n").cast("int"), most.cast("int").alias("most"))
    postings = postings.repartition("token").sortWithinPartitions("token", "n", "id")
    pairs = written(hubs(postings), "hubs")
    # Rows that repeat an id each have a sketch; the id stays if one of them can be similar to something.
    grouped = pairs.union(pairs.select("hub", F.col("hub").alias("id")).distinct()).join(sets.filter("n > 0").select("id", "n", "bits"), "id").select("hub", "id", "n", "bits")
    every, pairs = pairs, written(possible(grouped.repartition("hub").sortWithinPartitions("hub")).filter("id != hub").distinct(), "hubs")
    drop_written(every)
    scratch = [pairs]

    members = pairs.union(pairs.select("hub", F.col("hub").alias("id")).distinct())
    # Only hubs of more than one chunk are joined, and by broadcast where they are few: rows of one hub stay spread.
    n_chunks = pairs.groupBy("hub").agg(F.ceil((F.count("*") + 1) / BLOCK).cast("int").alias("chunks")).filter("chunks > 1")
    dealt = members.join(small_side(n_chunks, "chunks"), "hub", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("chunk", F.when(F.col("id") == F.col("hub"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))).withColumn("chunk", F.explode("chunk"))
    texts = docs.select(F.col(id_col).cast("long").alias("t_id"), F.col(text_col).alias("text")).filter("t_id is not null and text is not null")

    def searched(rows: DataFrame) -> DataFrame:
        with_text = rows.join(texts, F.col("id") == F.col("t_id")).select("hub", "chunk", "id", "role", "label", "text")
        return written(found_links(with_text.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "id")), "links")

    links = searched(dealt.select("hub", "chunk", "id", F.lit(0).alias("role"), F.monotonically_increasing_id().alias("label")))
    roots = written(components(links), "roots")
    scratch += [links, roots]

    large = dealt.filter("chunks > 1").select("hub", "chunk", "chunks", "id").join(roots, "id", "left").withColumn("label", F.coalesce("root", "id"))
    if large.limit(1).count():
        large = written(large.filter("id != hub").select("hub", "chunk", "chunks", "id", "label"), "large")
        main = large.groupBy("hub", "label").count().groupBy("hub").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
        outside = large.join(main, "hub").filter("label != main")
        asked = outside.select("hub", F.explode(F.expr("filter(sequence(0, chunks - 1), c -> c != chunk)")).alias("chunk"), "id", F.lit(2).alias("role"), "label")
        open_ = outside.select("hub").distinct()
        more = searched(large.join(open_, "hub", "left_semi").select("hub", "chunk", "id", F.lit(1).alias("role"), "label").union(asked))
        roots = written(components(links.union(more)), "roots")
        scratch += [large, more, roots]

    # Written, so that the join below is one of two plain exchanges, whose hot partitions Spark splits.
    classes = sets.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("id")).filter("id is not null")
    rooted = written(classes.join(roots, "id", "left").select("n", "h1", "h2", F.coalesce("root", "id").alias("component_id")), "rooted")
    for df in scratch:
        drop_written(df)
    return (
        sets.select("id", "n", "h1", "h2").join(rooted, ["n", "h1", "h2"], "left")
        .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that are not the first of their component; rows without an id stay, rows that repeat one stay once."""
    own = fresh(docs, "extra")
    extra = link_components(docs, id_col, text_col).filter("id != component_id").select(F.col("id").alias(own)).distinct()
    return docs.join(extra, F.col(id_col).cast("long") == F.col(own), "left_anti")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


#: Without skips or blocks: every pair that shares a shingle is counted, and labels spread along links.
OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(g) AS g FROM (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(root) AS component_id FROM r GROUP BY id) m ON m.id = d.doc_id
"""
