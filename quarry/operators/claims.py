"""Claims, conflicts between sources, works and citations between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import text as tx

CLAIM_TYPES = ("fact", "date", "measurement", "attribution", "interpretation", "tradition")
YEAR = r"\b(?:1[5-9]\d{2}|20[0-2]\d)\b"
BIB_SIGNAL = r"\(\s*(?:1[5-9]\d{2}|20[0-2]\d)\s*\)|,\s*(?:1[5-9]\d{2}|20[0-2]\d)\b|\bpp?\.\s*\d|\bvol\.\s*[IVXL\d]|\b(?:Press|Journal|University|Publishers?)\b"
CITATIONS = {
    "author_year": r"\(\s*([A-ZĀĪŪŚṢṆṬḌÑṚ][\p{L}’'-]+(?:\s+(?:and|&)\s+[A-Z][\p{L}’'-]+)?),?\s*(1[5-9]\d{2}|20[0-2]\d)\s*(?::\s*[\d–—,\s-]+)?\)",
    "narrative_year": r"\b([A-ZĀĪŪŚṢṆṬḌÑṚ][\p{L}’'-]{2,})\s*\(\s*(1[5-9]\d{2}|20[0-2]\d)\s*\)",
    "op_cit": r"\b([A-ZĀĪŪŚṢṆṬḌÑṚ][\p{L}’'-]{2,})\s*,\s*op\.\s*cit\.()",
    "ibid": r"(?i)\b(ibid)\b\.?()",
    "footnote_ref": r"(?<=[a-z)\"”])\s*\[(\d{1,3})\]()",
}
# Title words that tell nothing, and the letters that title words are made of.
COMMON_TITLE_WORDS = (
    "the", "of", "a", "an", "and", "in", "on", "its", "his", "her", "india", "indian", "study", "studies", "history", "vol", "volume",
    "part", "new", "delhi", "press", "university", "temple", "temples",
)
TITLE_WORD = r"([\p{L}\p{M}]{3,})"


def with_claim_ids(claims: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in ("scope", "source", "chunk_id", "subject_entity", "predicate", "object")]
    kind = F.when(F.col("claim_type").isin(*CLAIM_TYPES), F.col("claim_type")).otherwise("interpretation")
    return claims.withColumn("claim_id", tx.claim_id(*parts)).withColumn("claim_type", kind)


def conflicts(claims: DataFrame, scope: str = "corpus", min_sources: int = 2) -> DataFrame:
    """(subject_entity, relation, n_claims, n_sources, n_sides, kind, sides): claims of one subject and relation that differ.

    A relation is the first three distinct words of the predicate in order; sides are distinct objects.  A conflict
    is numeric if two sides or more have numbers and these differ.  Claims of one source don't conflict in the corpus.
    """
    rows = claims.filter(F.col("scope") == scope).withColumn("relation", F.array_join(tx.predicate_key(F.col("predicate")), " ")).filter("relation <> ''")
    side = rows.groupBy("subject_entity", "relation", F.lower(F.trim("object")).alias("side")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_set("chapter")).alias("chapters"), F.min("object").alias("object")
    )
    side = side.withColumn("nums", F.array_sort(tx.numbers(F.col("object"))))
    numbered = F.collect_set(F.when(F.size("nums") > 0, F.col("nums")))
    agg = side.groupBy("subject_entity", "relation").agg(
        F.sum("n").alias("n_claims"), F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("n_sources"), F.count("*").alias("n_sides"),
        F.count_if(F.size("nums") > 0).alias("n_numbered"), F.size(numbered).alias("n_numbers"), F.size(F.array_distinct(F.flatten(F.collect_list("chapters")))).alias("n_chapters"),
        F.array_sort(F.collect_list(F.struct("side", "object", "sources", "chapters"))).alias("sides"),
    )
    need = F.col("n_sources") >= (min_sources if scope == "corpus" else 1)
    found = agg.filter((F.col("n_claims") >= 2) & need & (F.col("n_sides") >= 2))
    kind = F.when((F.col("n_numbered") >= 2) & (F.col("n_numbers") >= 2), "numeric").otherwise("verbal")
    return found.withColumn("kind", kind).drop("n_numbered", "n_numbers")


def ordered_conflicts(found: DataFrame) -> DataFrame:
    return found.orderBy(F.when(F.col("kind") == "numeric", 0).otherwise(1), F.desc("n_sides"), "subject_entity", "relation")


def manuscript_contradictions(claims: DataFrame) -> DataFrame:
    return conflicts(claims, "manuscript").filter("n_chapters > 1")


def with_authority(found: DataFrame, sources: DataFrame) -> DataFrame:
    """(subject_entity, relation, side, source, kind_of_source, stance, reliability): what is known of each side's sources."""
    rows = found.select("subject_entity", "relation", F.explode("sides").alias("s")).select("subject_entity", "relation", "s.side", F.explode("s.sources").alias("source"))
    s = sources.select("source", F.col("kind").alias("kind_of_source"), F.substring("stance", 1, 220).alias("stance"), F.slice("reliability", 1, 2).alias("reliability"))
    return rows.join(s, "source", "left")


# ---- bibliography and citations -----------------------------------------------------------------


def bibliography_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: (F.length(F.trim(x)) >= 24) & x.rlike(BIB_SIGNAL))


def bibliography_rows(rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """rows labelled as bibliography or footnotes, or with three or more lines that look like entries."""
    dense = F.size(bibliography_lines(F.col("text"))) >= 3
    if labels is None:
        return rows.filter(dense)
    l = labels.select(F.col("chunk_id").alias("_c"), "structural")
    return rows.join(l, F.col("rowid") == F.col("_c"), "left").filter(F.coalesce(F.col("structural").isin("bibliography", "footnote"), F.lit(False)) | dense).drop("_c", "structural")


def bibliography_entries(rows: DataFrame) -> DataFrame:
    """(source, chunk_id, pos, author, raw): wrapped lines joined, authors carried over dashes.

    A line starts an entry if it begins with a name and a comma or with a dash, unless the line before is unfinished.
    """
    lines = rows.select("source", F.col("rowid").alias("chunk_id"), F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.trim("line") != "")
    order = W.partitionBy("source", "chunk_id").orderBy("pos")
    start = r"^\s*(?:\[\d{1,3}\]\s*)?(?:[—–]{1,2}|-{2,}|\p{Lu}[\p{L}’'.-]+(?:\s+\p{Lu}[\p{L}’'.-]+)*,\s)"
    before = F.lag("line").over(order)
    fresh = F.col("line").rlike(start) & (before.isNull() | F.rtrim(before).rlike(r"[)\]}]\s*\.?$|\b\d{4}\s*\)?\.?$|[.;]$"))
    grouped = lines.withColumn("entry", F.sum(fresh.cast("int")).over(order)).filter("entry > 0")
    raw = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.trim("line").alias("line")))), lambda x: x["line"]), " ")
    out = grouped.groupBy("source", "chunk_id", "entry").agg(F.min("pos").alias("pos"), raw.alias("raw"))
    out = out.filter((F.length("raw") >= 24) & F.col("raw").rlike(BIB_SIGNAL))
    name = F.regexp_extract("raw", r"^\s*(?:\[\d{1,3}\]\s*)?(\p{Lu}[^—–,(]*(?:,\s*\p{Lu}[\p{L}.’' -]*)?)", 1)
    carried = F.last(F.when(name != "", F.trim(name)), True).over(W.partitionBy("source").orderBy("chunk_id", "pos"))
    return out.withColumn("author", carried).drop("entry")


def citation_surfaces(rows: DataFrame) -> DataFrame:
    """(source, chunk_id, kind, author, year, surface): in-text citations of five kinds."""
    t = F.coalesce("text", F.lit(""))
    parts = []
    for kind, p in CITATIONS.items():
        zipped = F.arrays_zip(F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias("surface"), F.regexp_extract_all(t, F.lit(p), F.lit(1)).alias("a"), F.regexp_extract_all(t, F.lit(p), F.lit(2)).alias("y"))
        parts.append(rows.select("source", F.col("rowid").alias("chunk_id"), F.lit(kind).alias("kind"), F.explode(zipped).alias("z")).select("source", "chunk_id", "kind", F.col("z.a").alias("author"), F.expr("nullif(z.y, '')").cast("int").alias("year"), F.substring("z.surface", 1, 200).alias("surface")))
    return reduce(DataFrame.union, parts)


def citation_tables(surfaces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(works, citations) of those with an author and a year, keyed by the work they name."""
    named = surfaces.filter(F.col("kind").isin("author_year", "narrative_year")).withColumn("work_id", tx.work_key(F.col("author"), F.lit(""), F.col("year")))
    works = named.groupBy("work_id").agg(F.min("author").alias("author"), F.min("year").alias("year"))
    return works, named.dropDuplicates(["source", "work_id", "chunk_id", "surface"])


def citation_graph(citations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, shared): weights of source and work; how many sources cite each work."""
    edges = citations.groupBy("source", "work_id").agg(F.count("*").alias("n"))
    return edges, edges.groupBy("work_id").agg(F.count("*").alias("n_sources"), F.sum("n").alias("n_citations"))


def title_tokens(c: Column) -> Column:
    """Distinct folded words of four or more characters without the common ones."""
    found = F.transform(F.regexp_extract_all(tx.empty_if_null(c), F.lit(TITLE_WORD), F.lit(1)), tx.fold)
    return F.array_except(F.filter(found, lambda x: F.length(x) >= 4), F.array(*[F.lit(w) for w in COMMON_TITLE_WORDS]))


def title_contained(a: Column, b: Column, least: int = 12) -> Column:
    return (F.least(F.length(a), F.length(b)) >= least) & (a.contains(b) | b.contains(a))


def _grams(c: Column, q: int) -> Column:
    """The distinct runs of q characters; none of a shorter string."""
    at = F.sequence(F.lit(1), F.length(c) - q + 1)
    return F.when(F.length(c) >= q, F.array_distinct(F.transform(at, lambda i: F.substring(c, i, F.lit(q))))).otherwise(F.array().cast("array<string>"))


def contained_pairs(short: DataFrame, long: DataFrame, q: int = 12) -> DataFrame:
    """(s, l): strings s of `short` of q characters or more that stand in strings l of `long`, both tables of one column.

    A string can only stand where all its runs of q characters do, so one that has a run which no long string has is
    left out, and the others meet long strings on their rarest run.
    """
    s, l = short.select(F.col(short.columns[0]).alias("s")).distinct(), long.select(F.col(long.columns[0]).alias("l")).distinct()
    runs = l.select("l", F.explode(_grams(F.col("l"), q)).alias("g"))
    own = s.withColumn("gs", _grams(F.col("s"), q)).select("s", F.size("gs").alias("n"), F.explode("gs").alias("g"))
    known = own.join(runs.groupBy("g").agg(F.count("*").alias("df")), "g").groupBy("s", "n").agg(F.count("*").alias("found"), F.min(F.struct("df", "g")).alias("rarest"))
    return known.filter("found = n").select("s", F.col("rarest.g").alias("g")).join(runs, "g").filter(F.col("l").contains(F.col("s"))).select("s", "l")


def work_candidates(works: DataFrame, identities: DataFrame, least: int = 12) -> DataFrame:
    """works (..., sn, tf, tt) with the source of each identity that shares anything a score needs: an alias, a surname, a title
    inside the other, a title word that only one source has, or two title words.

    Of a work's title words the one that most sources have isn't looked up: two words in common leave another.
    """
    sources = lambda c, name: identities.select(F.col("source"), F.explode(F.array_distinct(c)).alias(name))
    by_alias = works.filter("tf <> ''").join(sources("aliases", "tf"), "tf")
    by_name = works.filter("sn <> ''").join(sources("surnames", "sn"), "sn")
    tokens = sources("title_tokens", "tok")
    df = tokens.groupBy("tok").agg(F.count("*").alias("df"))
    mine = works.select("tt").distinct().select("tt", F.explode(F.array_distinct("tt")).alias("tok")).join(df, "tok")
    mine = mine.withColumn("most", F.row_number().over(W.partitionBy("tt").orderBy(F.desc("df"), "tok"))).filter("df = 1 or most > 1")
    by_words = works.join(mine.join(tokens, "tok").select("tt", "source").distinct(), "tt")
    titles = identities.select("source", "title_fold")
    inside = contained_pairs(works.select("tf"), titles.select("title_fold"), least)
    around = contained_pairs(titles.select("title_fold"), works.select("tf"), least)
    both = inside.select(F.col("s").alias("tf"), F.col("l").alias("title_fold")).union(around.select(F.col("l").alias("tf"), F.col("s").alias("title_fold"))).distinct()
    by_title = works.join(both.join(titles, "title_fold").select("tf", "source"), "tf")
    columns = [*works.columns, "source"]
    return by_alias.select(columns).union(by_name.select(columns)).union(by_words.select(columns)).union(by_title.select(columns)).distinct()


def match_works(works: DataFrame, identities: DataFrame, min_score: int = 2) -> DataFrame:
    """(work_id, source, score): the corpus source that a work most likely is, the first of equals.

    identities: (source, ord, title_fold, title_tokens, surnames, years, aliases), one row a source of the corpus.  Alias 3; title
    contained 3, else two rare tokens 2, else one rare or two narrow ones 1; surname 2; year 1 beside one of these.  One shared
    common token never links.  Only pairs that share something are scored.
    """
    df = identities.select(F.explode(F.array_distinct("title_tokens")).alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))
    own = identities.select("source", F.explode(F.array_distinct("title_tokens")).alias("tok")).join(df.filter("df = 1"), "tok").groupBy("source").agg(F.collect_set("tok").alias("rare"))
    w = works.select("work_id", "year", tx.surname(F.col("author")).alias("sn"), tx.fold(F.coalesce("title", F.lit(""))).alias("tf"), title_tokens(F.col("title")).alias("tt"))
    details = identities.join(own.withColumnRenamed("source", "r_source"), F.col("source").eqNullSafe(F.col("r_source")), "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<string>")))
    details = details.select(F.col("source").alias("i_source"), "ord", "title_fold", "title_tokens", "surnames", "years", "aliases", "rare")
    rows = work_candidates(w, identities).join(details, F.col("source").eqNullSafe(F.col("i_source")))
    common = F.array_intersect("tt", "title_tokens")
    n_rare, n = F.size(F.array_intersect(common, "rare")), F.size(common)
    title = F.when(title_contained(F.col("tf"), F.col("title_fold")), 3).when(n_rare >= 2, 2).when((n_rare >= 1) | (n >= 2), 1).otherwise(0)
    alias = F.when(F.array_contains("aliases", F.col("tf")) & (F.col("tf") != ""), 3).otherwise(0)
    sn = F.when(F.array_contains("surnames", F.col("sn")) & (F.col("sn") != ""), 2).otherwise(0)
    year = F.when(F.array_contains("years", F.col("year")), 1).otherwise(0)
    scored = rows.withColumn("score", alias + title + sn + F.when((alias + title + sn) > 0, year).otherwise(0)).filter(F.col("score") >= min_score)
    return scored.withColumn("_r", F.row_number().over(W.partitionBy("work_id").orderBy(F.desc("score"), "ord"))).filter("_r = 1").select("work_id", "source", "score")


def link_works(works: DataFrame, matches: DataFrame) -> DataFrame:
    m = matches.select("work_id", F.col("source").alias("in_corpus"))
    return works.drop("in_corpus").join(m, "work_id", "left")


def source_profile(chunks: DataFrame, labels: DataFrame, mentions: DataFrame, citations: DataFrame) -> DataFrame:
    """(source, chunks, chars, structural map, top_entities, works) of each source."""
    base = chunks.groupBy("source").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"))
    lab = chunks.select("source", F.col("rowid").alias("chunk_id")).join(labels, "chunk_id").groupBy("source", "structural").agg(F.count("*").alias("n"))
    lab = lab.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("structural", "n")))).alias("structural"))
    ent = chunks.select("source", F.col("rowid").alias("chunk_id")).join(mentions, "chunk_id").groupBy("source", "entity_id").agg(F.sum("n").alias("n"))
    ent = ent.withColumn("_r", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n"), "entity_id"))).filter("_r <= 12")
    ent = ent.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "entity_id"))), lambda x: x["entity_id"]).alias("top_entities"))
    cit = citations.groupBy("source").agg(F.countDistinct("work_id").alias("works"))
    return base.join(lab, "source", "left").join(ent, "source", "left").join(cit, "source", "left").fillna(0, ["works"])


def corpus_identities(titles: DataFrame) -> DataFrame:
    """(source, ord, title_fold, title_tokens, surnames, years, aliases) from rows (source, title, author, year, alias)."""
    rows = titles.groupBy("source").agg(
        F.max_by("title", F.length("title")).alias("t"), F.array_sort(F.collect_set(tx.surname(F.col("author")))).alias("surnames"),
        F.array_sort(F.collect_set("year")).alias("years"), F.array_sort(F.collect_set(tx.fold(F.col("alias")))).alias("aliases"),
    )
    rows = rows.withColumn("title_fold", tx.fold(F.coalesce("t", F.lit("")))).withColumn("title_tokens", title_tokens(F.col("t")))
    return rows.withColumn("ord", F.col("source")).drop("t")
