"""Merkle manifest of a table: a digest a row, a tree a group, a tree over the groups, a proof a row.

Bottom-up build: the nodes of a level that one task joins are runs of ``2 ** STRIDE`` consecutive ones.  A run is
folded through STRIDE levels where it is, and its row, with all the nodes inside, is persisted; the nodes that
runs end in are the next table's children.  The number of tables is the logarithm of the largest group to base
2 ** STRIDE, and no row or task holds more than one run, whatever the size of a group.

Top-down proof push: persisted runs hand each child the siblings from that child to the top.  A child prepends
the siblings inside its own run to the suffix that it inherits.  A sibling is kept with its side, so a root can be
folded from any leaf and its proof alone.

Levels: leaves stand in order of the id, nulls first, ties by digest; while a group has several nodes, every two
consecutive ones become the digest of their concatenation, and a last one that is left over the digest of itself.
Groups stand in order of their key, null first, bytewise.

Nulls: a null field is written "-"; a null group key is a group; a null id sorts first and is never tampered with.
Repeated rows are leaves of their own.  Empty texts are fields of 0 bytes; a text of any length is hashed whole.
An empty table gives an empty result.  Other columns take no part, whatever their names.
Only built-in functions run; groups are numbered by ranges, so none is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.numbering import numbered
from .common import drop_written, small_side, table, written

#: Levels that are folded in one persisted table.
STRIDE = 8
RUN = 1 << STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """Byte count, colon, value; "-" if null."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return digest(F.concat(*[field(c) for c in columns.values()]))


def tampered(doc_id: Column) -> Column:
    """Is 7 a divisor of the checksum of the id?  A null id has none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def pairs_folded(nodes: Column) -> Column:
    """The next level: digests of every two consecutive nodes, of a last one by itself."""
    firsts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(2))
    return F.transform(firsts, lambda i: digest(F.concat(F.get(nodes, i), F.coalesce(F.get(nodes, i + 1), F.lit("")))))


def levels_of(nodes: Column, steps: Column) -> Column:
    """The nodes and the `steps` levels above them, an array a level."""
    ups = F.filter(F.sequence(F.lit(0), F.lit(STRIDE)), lambda i: (i > 0) & (i <= steps))
    return F.aggregate(ups, F.array(nodes), lambda acc, _: F.concat(acc, F.array(pairs_folded(F.element_at(acc, -1)))))


def siblings(levels: Column, place: Column) -> Column:
    """What stands beside the path from the node at a place to the top of its run, level by level: the digest
    after "l" or "r" for the side it is on, "" where the path's node is alone."""
    below = F.sequence(F.lit(1), F.lit(STRIDE))
    below = F.filter(below, lambda i: i < F.size(levels))

    def beside(i: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(2.0), (i - 1).cast("double"))).cast("int")
        nodes = F.element_at(levels, i)
        right = F.get(nodes, at + 1)
        return F.when(at % 2 == 1, F.concat(F.lit("l"), F.get(nodes, at - 1))).when(right.isNotNull(), F.concat(F.lit("r"), right)).otherwise(F.lit(""))

    return F.transform(below, beside)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    own = lambda s: F.substr(s, F.lit(2))
    return F.aggregate(proof, leaf, lambda acc, s: digest(F.when(s.startswith("l"), F.concat(own(s), acc)).otherwise(F.concat(acc, own(s)))))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.substr(s, F.lit(2))), ""))


def _runs(nodes: DataFrame, name: str) -> DataFrame:
    """nodes (g, n, pos, h, item): the persisted rows (g, n, run, items, levels) of their runs; n is the group's number of nodes."""
    # ceil(log2(n)): 0 for a single node, which is its group's root as it is.
    steps = F.least(F.lit(STRIDE), F.ceil(F.log2(F.col("n").cast("double")) - 1e-12)).cast("int")
    item = F.struct("pos", "h", *[c for c in nodes.columns if c == "item"])
    runs = nodes.groupBy("g", "n", F.shiftright("pos", STRIDE).alias("run")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return written(runs.withColumn("levels", levels_of(F.transform("items", lambda x: x["h"]), steps)), name)


def build(leaves: DataFrame, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The persisted tables of trees, lowest first, and (g, h) of their roots.  largest: of all n."""
    tables, roots, n = [_runs(leaves, name)], None, largest
    while True:
        top = F.element_at(F.element_at("levels", -1), 1)
        ended = tables[-1].filter(F.col("n") <= RUN).select("g", top.alias("h"))
        roots = ended if roots is None else roots.union(ended)
        if n <= RUN:
            return tables, roots
        nodes = tables[-1].filter(F.col("n") > RUN).select("g", F.ceil(F.col("n") / RUN).cast("long").alias("n"), F.col("run").alias("pos"), top.alias("h"))
        n = -(-n // RUN)
        tables.append(_runs(nodes, name))


def pushed(tables: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """The lowest table's runs with `suffix`: the siblings from the run's own root upwards, suffixes (g, suffix) of the roots included."""
    inherited = None
    for i, runs in reversed(list(enumerate(tables))):
        tops = runs.filter(F.col("n") <= RUN).select("g", "run").join(suffixes, "g")
        inherited = tops if inherited is None else inherited.unionByName(tops)
        with_suffix = runs.join(inherited, ["g", "run"])
        if i == 0:
            return with_suffix
        inherited = _proven(with_suffix).select("g", F.col("x.child.pos").alias("run"), F.col("x.proof").alias("suffix"))
    raise AssertionError


def _proven(runs: DataFrame) -> DataFrame:
    """A row for each item of the runs, with x: (child, proof).  Proofs are made in the run's row, so that its levels aren't copied a child."""
    each = F.transform("items", lambda c, at: F.struct(c.alias("child"), F.concat(siblings(F.col("levels"), at), F.col("suffix")).alias("proof")))
    return runs.select("g", F.explode(each).alias("x"), *[c for c in runs.columns if c == "subroot"])


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None, suspect: Column | None = None) -> DataFrame:
    """(id, group, leaf, subroot, root, proof, proof_sha256, folded_root, verified), a row for each row of docs.

    folded_root comes from the row as it is now, with `changed` columns where `suspect` holds, and from the proof that was
    built before; verified says whether that is the root.
    """
    before = {c: F.col(c) for c in fields}
    now = before | (changed or {})
    leaf = leaf_digest(before)
    later = F.when(suspect, leaf_digest(now)).otherwise(leaf) if suspect is not None else leaf
    passing: list[DataFrame] = []

    def passed(df: DataFrame, name: str) -> DataFrame:
        """A table that only the persisted runs are made from."""
        passing.append(written(df, name))
        return passing[-1]

    leaves = passed(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf.alias("h"), later.alias("later")), "merkle-leaves")

    groups = passed(numbered(leaves.groupBy("grp").agg(F.count("*").alias("n")), ["grp"], name="pos", start=0, write=passed), "merkle-groups")
    n_groups, largest = groups.agg(F.count("*"), F.max("n")).first()
    if not n_groups:
        shape = "id {}, grp {}, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string, verified boolean"
        types = dict(leaves.dtypes)
        return docs.sparkSession.createDataFrame([], shape.format(types["id"], types["grp"]))
    keys = small_side(groups.select(F.col("grp").alias("_grp"), F.col("pos").alias("g"), "n"), "merkle-keys")
    placed = numbered(leaves.join(keys, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp"), ["id", "h"], within=["g"], name="pos", start=0, write=passed, side=small_side)
    tables, roots = build(placed.select("g", "n", "pos", "h", F.struct("id", "grp", "later").alias("item")), largest, "merkle-runs")

    subroots = written(roots, "merkle-subroots")
    over = subroots.select(F.lit(0).cast("long").alias("g"), F.lit(n_groups).cast("long").alias("n"), F.col("g").alias("pos"), "h")
    top_tables, top_roots = build(over, n_groups, "merkle-top")
    root = top_roots.first()["h"]
    none = F.array().cast("array<string>")
    top = pushed(top_tables, top_tables[-1].select("g").distinct().withColumn("suffix", none))
    suffixes = _proven(top).select(F.col("x.child.pos").alias("g"), F.col("x.proof").alias("suffix"), F.col("x.child.h").alias("subroot"))
    suffixes = small_side(suffixes, "merkle-suffixes")

    runs = pushed(tables, suffixes.select("g", "suffix")).join(suffixes.select("g", "subroot"), "g")
    leaf = F.col("x.child")
    proven = _proven(runs).select(
        leaf["item"]["id"].alias("id"), leaf["item"]["grp"].alias("grp"), leaf["h"].alias("leaf"), "subroot", F.lit(root).alias("root"), leaf["item"]["later"].alias("later"), F.col("x.proof").alias("proof"),
    )
    for df in (*passing, subroots, *top_tables):
        drop_written(df)
    out = proven.withColumn("proof_sha256", proof_digest(F.col("proof"))).withColumn("folded_root", folded(F.col("later"), F.col("proof")))
    return out.drop("later").withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    found = manifest(docs, changed={"n_chars": F.col("n_chars") + 1}, suspect=tampered(F.col("doc_id")))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: Level by level over whole tables: a node's sibling is looked up by its place, and roots are folded one level a step.
OP11_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 7 = 0, false) AS bad
  FROM documents),
leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(CASE WHEN bad THEN strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END, '-') || tail) AS later
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaf),
low(g, lvl, pos, h, n) AS (
  SELECT g, 0, pos, leaf, n FROM placed
  UNION ALL SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY g, lvl, pos // 2, n),
high(lvl, pos, h, n) AS (
  SELECT 0, g, h, count(*) OVER () FROM low WHERE n = 1
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY lvl, pos // 2, n),
tops AS (SELECT DISTINCT ON (g) g, lvl AS height, h AS subroot FROM low WHERE n = 1),
steps AS (
  SELECT p.g, p.pos, l.lvl, (p.pos >> l.lvl) % 2 = 1 AS after_it, s.h
  FROM placed p JOIN (SELECT DISTINCT g, lvl FROM low WHERE n > 1) l USING (g) LEFT JOIN low s ON s.g = p.g AND s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, 1)
  UNION ALL
  SELECT p.g, p.pos, t.height + l.lvl, (p.g >> l.lvl) % 2 = 1, s.h
  FROM placed p JOIN tops t USING (g) CROSS JOIN (SELECT DISTINCT lvl FROM high WHERE n > 1) l LEFT JOIN high s ON s.lvl = l.lvl AND s.pos = xor(p.g >> l.lvl, 1)),
proofs AS (
  SELECT p.g, p.pos, any_value(p.later) AS later, sha256(coalesce(string_agg(coalesce(s.h, ''), '' ORDER BY s.lvl), '')) AS proof_sha256,
    coalesce(list(CASE WHEN s.h IS NULL THEN '' WHEN after_it THEN 'l' || s.h ELSE 'r' || s.h END ORDER BY s.lvl) FILTER (s.lvl IS NOT NULL), CAST([] AS VARCHAR[])) AS path
  FROM placed p LEFT JOIN steps s USING (g, pos) GROUP BY p.g, p.pos)
SELECT p.doc_id, p.leaf, t.subroot, r.h AS root, q.proof_sha256, q.folded_root, q.folded_root = r.h AS verified
FROM placed p JOIN tops t USING (g)
JOIN (SELECT g, pos, proof_sha256, list_reduce(list_concat([later], path), lambda acc, s: sha256(CASE WHEN s[1] = 'l' THEN s[2:] || acc ELSE acc || s[2:] END)) AS folded_root FROM proofs) q USING (g, pos)
CROSS JOIN (SELECT DISTINCT h FROM high WHERE n = 1) r
"""
