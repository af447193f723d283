"""Evidence packs, citations and verdicts: validation, resolution and grounding of drafts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import numeric, text as tx

EID = r"\[(E\d+)\]"
GAP = r"\[GAP[^\]]*\]"
VERDICTS = ("supported", "partial", "unsupported", "contradicted", "unverified")


# ---- packs --------------------------------------------------------------------------------------


def passages(packs: DataFrame) -> DataFrame:
    """(n, sub_ord, sub, pos, passage fields...): nested packs as rows."""
    subs = packs.select("n", F.posexplode("subtopics").alias("sub_ord", "s"))
    return subs.select("n", "sub_ord", F.col("s.key").alias("sub"), F.posexplode("s.passages").alias("pos", "p")).select("n", "sub_ord", "sub", "pos", "p.*")


def evidence_ids(rows: DataFrame, chapter: str = "chapter") -> DataFrame:
    """rows (chapter, sub_ord, pos) with id E1, E2... over the whole chapter and repeated: shown before in it."""
    order = W.partitionBy(chapter).orderBy("sub_ord", "pos")
    seen = F.row_number().over(W.partitionBy(chapter, "source", "chunk").orderBy("sub_ord", "pos"))
    return rows.withColumn("id", F.concat(F.lit("E"), F.row_number().over(order).cast("string"))).withColumn("repeated", seen > 1)


def build_packs(rows: DataFrame, subs: DataFrame, titles: DataFrame) -> DataFrame:
    """Nested packs again: (chapter, title, subtopics array); sub-topics without passages stay."""
    fields = ["id", "chunk", "source", "trail", "heading", "page_start", "page_end", "text"]
    p = F.array_sort(F.collect_list(F.struct("pos", *fields, F.bround("score", 4).alias("score"))))
    per_sub = rows.groupBy("chapter", "sub").agg(p.alias("passages"))
    s = subs.join(per_sub, ["chapter", "sub"], "left")
    empty = F.array().cast(per_sub.schema["passages"].dataType)
    nested = s.groupBy("chapter").agg(F.array_sort(F.collect_list(F.struct("sub_ord", "sub", "status", F.coalesce("passages", empty).alias("passages")))).alias("subtopics"))
    return titles.join(nested, "chapter", "left")


def validate_passages(rows: DataFrame, known_sources: DataFrame | None = None, require_pages: bool = False) -> DataFrame:
    """rows (n, sub, id, source, text, page_start) with errors, warnings and duplicate_of: the first id of its text."""
    norm = F.regexp_replace(F.lower(F.trim(F.coalesce("text", F.lit("")))), r"\s+", " ")
    rows = rows.withColumn("_h", F.sha1(norm.cast("binary"))).withColumn("_ord", F.regexp_extract("id", r"(\d+)$", 1).cast("int"))
    same = W.partitionBy("n", "_h").orderBy("_ord")
    rows = rows.withColumn("_first", F.first("id").over(same)).withColumn("_nth", F.row_number().over(same)).withColumn("_ids", F.count("*").over(W.partitionBy("n", "id")))
    rows = rows.withColumn("duplicate_of", F.when((F.col("_nth") > 1) & (norm != ""), F.col("_first")))
    if known_sources is not None:
        rows = rows.join(known_sources.select("source", F.lit(True).alias("_known")), "source", "left")
    else:
        rows = rows.withColumn("_known", F.lit(True))
    no_page = F.col("page_start").isNull()
    errors = F.array_compact(F.array(
        F.when(norm == "", F.lit("empty-text")), F.when(F.coalesce(F.trim("source"), F.lit("")) == "", F.lit("no-source")), F.when(F.col("_ids") > 1, F.lit("repeated-id")), F.when(no_page & F.lit(require_pages), F.lit("no-page")),
    ))
    warnings = F.array_compact(F.array(F.when(F.col("_known").isNull(), F.lit("unmapped-source")), F.when(no_page & ~F.lit(require_pages), F.lit("no-page")), F.when(F.col("duplicate_of").isNotNull(), F.lit("duplicate"))))
    return rows.withColumn("errors", errors).withColumn("warnings", warnings).drop("_h", "_ord", "_first", "_nth", "_ids", "_known")


def pack_report(subs: DataFrame, checked: DataFrame, min_passages: int = 2) -> DataFrame:
    """(n, n_subs, n_passages, usable, n_sources, gaps, thin, n_errors, n_warnings, status) of each pack; subs: (n, sub)."""
    per_sub = subs.join(checked.groupBy("n", "sub").agg(F.count("*").alias("k")), ["n", "sub"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
    s = per_sub.groupBy("n").agg(F.count("*").alias("n_subs"), F.count_if(F.col("k") == 0).alias("gaps"), F.count_if((F.col("k") > 0) & (F.col("k") < min_passages)).alias("thin"))
    p = checked.groupBy("n").agg(
        F.count("*").alias("n_passages"), F.count_if(F.col("duplicate_of").isNull()).alias("usable"), F.countDistinct("source").alias("n_sources"),
        F.sum(F.size("errors")).alias("n_errors"), F.sum(F.size("warnings")).alias("n_warnings"),
    )
    rows = s.join(p, "n", "left").fillna(0)
    fail = (F.col("n_errors") > 0) | (F.col("n_passages") == 0)
    return rows.withColumn("status", F.when(fail, "fail").when((F.col("n_warnings") > 0) | (F.col("gaps") > 0) | (F.col("thin") > 0), "warn").otherwise("ok"))


# ---- citations ----------------------------------------------------------------------------------


def cited_ids(body: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(EID), F.lit(1))


def resolve_citations(bodies: DataFrame, passages_: DataFrame) -> DataFrame:
    """bodies (n, body) with resolved, cited and bogus: [E12] becomes [k] by first appearance; unknown ids go and are reported."""
    known = passages_.groupBy(F.col("n").alias("_n")).agg(F.collect_set("id").alias("_known"))
    rows = bodies.join(known, F.col("n") == F.col("_n"), "left").withColumn("_known", F.coalesce("_known", F.array().cast("array<string>"))).drop("_n")
    ids = F.array_distinct(cited_ids(F.col("body")))
    rows = rows.withColumn("cited", F.filter(ids, lambda x: F.array_contains("_known", x))).withColumn("bogus", F.filter(ids, lambda x: ~F.array_contains("_known", x)))
    marks = F.transform("cited", lambda x, i: F.struct(F.concat(F.lit("["), x, F.lit("]")).alias("a"), F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]")).alias("b")))
    gone = F.transform("bogus", lambda x: F.struct(F.concat(F.lit("["), x, F.lit("]")).alias("a"), F.lit("").alias("b")))
    text = F.aggregate(F.concat(gone, marks), F.coalesce("body", F.lit("")), lambda acc, m: F.replace(acc, m["a"], m["b"]))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+([.,;:])", "$1"), r"[ \t]{2,}", " ")
    return rows.withColumn("resolved", text).drop("_known")


def _counted(rows: DataFrame, ids: Column, name: str) -> DataFrame:
    return rows.select("n", F.explode(ids).alias("id")).groupBy("n", "id").agg(F.count("*").alias(name))


def citation_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(n, id, dropped, added): as multisets, so one of two mentions lost is one dropped; GAP counts gap marks."""
    ids = lambda c: F.concat(cited_ids(F.col(c)), F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({GAP})"), F.lit(1)), lambda x: F.lit("GAP")))
    b, a = _counted(before, ids("body"), "b"), _counted(after, ids("body"), "a")
    rows = b.join(a, ["n", "id"], "full_outer").fillna(0, ["a", "b"])
    rows = rows.select("n", "id", F.greatest(F.col("b") - F.col("a"), F.lit(0)).alias("dropped"), F.greatest(F.col("a") - F.col("b"), F.lit(0)).alias("added"))
    return rows.filter("dropped > 0 or added > 0")


def edit_accepted(before: Column, after: Column, max_growth: float = 1.15, max_new_gaps: int = 6) -> Column:
    """A repair is taken if it doesn't grow much, adds few gap marks and none to a heading."""
    words = lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))
    gaps = lambda c: F.regexp_count(c, F.lit(GAP))
    return (words(after) <= words(before) * max_growth) & (gaps(after) - gaps(before) <= max_new_gaps) & ~after.rlike(r"(?m)^#{1,6} .*\[GAP")


# ---- verdicts -----------------------------------------------------------------------------------


def verdict_rates(claims: DataFrame, by: str = "section") -> DataFrame:
    """Counts by verdict; what is missing or unknown is unverified, which no rate counts as judged wrong.

    rate: supported among judged (1 without any); coverage: judged among all.
    """
    v = F.when(F.lower("verdict").isin(*VERDICTS), F.lower("verdict")).otherwise("unverified")
    rows = claims.withColumn("_v", v).groupBy(by)
    agg = rows.agg(*[F.count_if(F.col("_v") == x).alias(x) for x in VERDICTS])
    judged = reduce(lambda a, b: a + b, [F.col(x) for x in VERDICTS[:4]])
    agg = agg.withColumn("checked", judged)
    return agg.withColumn("rate", F.coalesce(F.try_divide("supported", "checked"), F.lit(1.0))).withColumn("coverage", F.coalesce(F.try_divide(F.col("checked"), F.col("checked") + F.col("unverified")), F.lit(1.0)))


def ungrounded(sections: DataFrame, passages_: DataFrame, aliases) -> DataFrame:
    """(sub, term, kind): proper nouns that the passages don't attest and numerals they don't have, longest first by rank."""
    from .entities import unattested

    nouns = unattested(sections.select("sub", F.explode(tx.proper_nouns(F.col("text"))).alias("term")), passages_, aliases)
    have = passages_.select("sub", F.explode(tx.numerals(F.col("text"))).alias("term")).distinct()
    nums = sections.select("sub", F.explode(tx.numerals(F.col("text"))).alias("term")).distinct().join(have, ["sub", "term"], "left_anti")
    rows = nouns.withColumn("kind", F.lit("name")).union(nums.withColumn("kind", F.lit("number")))
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("sub").orderBy(F.desc(F.length("term")), "term")))


def cut_quotes(text: Column, quotes: Column, mark: str = "[GAP: not supported by the evidence]", most: int = 6, least_words: int = 6) -> Column:
    """text with the first place of each of at most `most` long verbatim quotes replaced; headings stay, runs of marks become one."""
    long = F.filter(quotes, lambda q: F.size(F.split(F.trim(q), r"\s+")) >= least_words)
    # A quote inside a heading is left: lines are cut one by one.
    def cut(acc: Column, q: Column) -> Column:
        at = F.locate("\x00", F.replace(acc, q, F.lit("\x00")))
        line = F.element_at(F.split(F.substring(acc, F.lit(1), F.greatest(at - 1, F.lit(0))), "\n"), -1)
        ok = (at > 0) & ~line.startswith("#")
        return F.when(ok, F.concat(F.substring(acc, F.lit(1), at - 1), F.lit(mark), F.substring(acc, at + F.length(q), F.length(acc)))).otherwise(acc)

    out = F.aggregate(F.slice(long, 1, most), text, cut)
    one = mark.replace("[", r"\[").replace("]", r"\]")
    return F.regexp_replace(out, rf"(?:{one}\s*){{2,}}", mark + " ")


def fact_coverage(supported: Column, facts: Column, passages_: Column) -> Column:
    """Share of facts supported; null without facts, 0 without passages."""
    return F.when(F.size(facts) == 0, None).when(F.size(passages_) == 0, 0.0).otherwise(supported / F.size(facts))


def new_facts(text: Column, allowed_tokens: Column, allowed_numbers: Column) -> tuple[Column, Column]:
    """(names, numbers) in text that the allowed vocabulary lacks."""
    names = F.filter(tx.proper_nouns(text), lambda w: ~F.array_contains(allowed_tokens, tx.fold(w)))
    return names, F.array_except(F.array_distinct(tx.numerals(text)), allowed_numbers)


def chapter_check(chapters: DataFrame) -> DataFrame:
    """chapters (n, body) with counts that show what is wrong: words, marks, notes, alignment, truncation, gaps, first person."""
    body = F.coalesce("body", F.lit(""))
    main, notes = F.element_at(F.split(body, "(?m)^## Notes"), 1), F.coalesce(F.get(F.split(body, "(?m)^## Notes"), F.lit(1)), F.lit(""))
    nums = lambda c, p: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(p), F.lit(1)), lambda x: x.cast("int"))))
    marks, listed = nums(main, r"\[(\d+)\]"), nums(notes, r"(?m)^\[?(\d+)[.\]]")
    return chapters.select(
        "n", F.size(F.filter(F.split(main, r"\s+"), lambda x: x != "")).alias("words"), F.size(marks).alias("marks"), F.size(listed).alias("notes"), (marks == listed).alias("aligned"),
        (~F.rtrim(main).rlike(r"[.!?\"”)\]]$")).alias("truncated"), F.regexp_count(body, F.lit(GAP)).alias("gaps"), F.regexp_count(main, F.lit(r"\b(?:I|[Mm]y|[Ww]e|[Oo]ur)\b")).alias("first_person"),
    )


def target_words(packs: DataFrame) -> DataFrame:
    """(n, target): from the number of sub-topics and the words of the evidence."""
    words = F.aggregate("subtopics", F.lit(0), lambda a, s: a + F.aggregate(s["passages"], F.lit(0), lambda b, p: b + F.size(F.split(F.coalesce(p["text"], F.lit("")), r"\s+"))))
    return packs.select("n", numeric.target_words(F.size("subtopics"), words).alias("target"))
