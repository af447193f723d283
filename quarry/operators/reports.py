"""Reports for people: retrieval records, blueprints, coherence, runs, pages; and prompts that list problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx

SHOWN = 40


def _lines(order: str, line: Column, joint: str = "\n") -> Column:
    """The lines of a group, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("line")))), lambda x: x["line"]), joint)


def _bullets(items: Column, none: str) -> Column:
    some = F.coalesce(items, F.array().cast("array<string>"))
    return F.when(F.size(some) > 0, F.array_join(F.transform(some, lambda x: F.when(x.startswith("-"), x).otherwise(F.concat(F.lit("- "), x))), "\n")).otherwise(F.lit(none))


# ---- retrieval ----------------------------------------------------------------------------------


def retrieval_record(subs: DataFrame, channels: DataFrame, fused: DataFrame, kept: DataFrame, backend: str, floor_mode: str, cut: int = 3) -> DataFrame:
    """(sub, record): what retrieval did for each sub-topic, for reading later.

    channels (sub, channel, rowid); fused (sub, rowid, rank, channels, score), scored and before the floor; kept (sub, rowid).
    """
    found = channels.groupBy("sub").agg(*[F.countDistinct(F.when(F.col("channel") == c, F.col("rowid"))).alias(c) for c in ("dense", "sparse", "entity")])
    all_ = fused.groupBy("sub").agg(F.count("*").alias("fused"))
    flags = kept.select("sub", "rowid", F.lit(True).alias("_kept")).distinct()
    scored = fused.join(flags, ["sub", "rowid"], "left")
    above = scored.filter("_kept").groupBy("sub").agg(F.count("*").alias("n_above_floor"))
    below = scored.filter("_kept is null").groupBy("sub").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "rowid"))), lambda x: F.struct(x["rowid"].alias("rowid"), (-x["s"]).alias("score"))), 1, cut).alias("just_below_floor"))
    by = scored.filter("_kept").select("sub", F.explode("channels").alias("c")).groupBy("sub", "c").agg(F.count("*").alias("n"))
    by = by.groupBy("sub").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("channels"))
    rows = subs.select("sub")
    for part in (found, all_, above, below, by):
        rows = rows.join(part, "sub", "left")
    rows = rows.fillna(0, ["dense", "sparse", "entity", "fused", "n_above_floor"])
    counts = F.struct("dense", "sparse", "entity", "fused").alias("counts")
    return rows.select("sub", F.struct("channels", counts, F.lit(backend).alias("reranker"), F.lit(floor_mode).alias("floor_mode"), "n_above_floor", "just_below_floor").alias("record"))


# ---- blueprints ---------------------------------------------------------------------------------


def blueprints(chapters: DataFrame, units: DataFrame, sub_units: DataFrame, references: DataFrame) -> DataFrame:
    """(chapter, markdown): plans of chapters as Markdown, with a coverage table.

    chapters (chapter, title, purpose, narrative, questions, dependencies, stamp); units (chapter, unit, id, title, primary,
    secondary, gaps), arrays of names; sub_units (chapter, unit, pos, id, title, topics, questions, unevidenced);
    references (chapter, unit, pos, rank, short, kind, locator, pages, passages, score, contribution).
    """
    cell = lambda c: F.coalesce(F.nullif(F.translate(c.cast("string"), "|\n", "/ "), F.lit("")), F.lit("—"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", cell(F.col("short")), cell(F.col("kind")), cell(F.substring("locator", 1, 60)), cell(F.col("pages")), cell(F.col("passages")), cell(F.format_number("score", 3)), cell(F.col("contribution"))), F.lit(" |"))
    refs = references.groupBy("chapter", "unit", "pos").agg(_lines("rank", line).alias("refs"), F.count("*").alias("n_refs"))
    head = F.lit("| source | kind | locator | pages | passages | score | contribution |\n|---|---|---|---|---:|---:|---|\n")
    s = sub_units.join(refs, ["chapter", "unit", "pos"], "left")
    part = lambda name, items: F.when(F.size(F.coalesce(items, F.array().cast("array<string>"))) > 0, F.concat(F.lit(f"**{name}**\n\n"), _bullets(items, ""), F.lit("\n")))
    missing = F.when(F.size("unevidenced") > 0, F.concat(F.lit("> **Not in the corpus:** "), F.array_join("unevidenced", ", "), F.lit(". Don't assert these.\n")))
    body = F.concat_ws(
        "\n", F.concat(F.lit("### "), "id", F.lit(" "), "title", F.lit("\n")), part("Topics", F.col("topics")), part("Questions", F.col("questions")),
        F.concat(F.lit("**References**\n\n"), F.coalesce(F.concat(head, "refs"), F.lit("*Nothing cleared the relevance floor.*")), F.lit("\n")), missing,
    )
    subs = s.groupBy("chapter", "unit").agg(_lines("pos", body).alias("subs"), F.count("*").alias("n_subs"), F.sum(F.coalesce("n_refs", F.lit(0))).alias("n_refs"))
    u = units.join(subs, ["chapter", "unit"], "left").fillna(0, ["n_subs", "n_refs"])
    plan = F.concat_ws("\n", F.lit("**Primary**\n"), _bullets(F.col("primary"), "- —"), F.lit("\n**Secondary**\n"), _bullets(F.col("secondary"), "- —"), F.lit("\n**Missing evidence**\n"), _bullets(F.col("gaps"), "- none"))
    unit_text = F.concat_ws("\n", F.concat(F.lit("## "), "id", F.lit(" "), "title", F.lit("\n")), "subs", plan)
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "id", cell(F.col("title")), F.col("n_subs").cast("string"), F.col("n_refs").cast("string"), F.size("primary").cast("string"), F.size("secondary").cast("string"), F.size("gaps").cast("string")), F.lit(" |"))
    per = u.groupBy("chapter").agg(_lines("unit", row).alias("table"), _lines("unit", unit_text, "\n\n---\n\n").alias("units"))
    rows = chapters.join(per, "chapter", "left")
    text = F.concat_ws(
        "\n", F.concat(F.lit("# Chapter "), F.col("chapter").cast("string"), F.lit(" — "), "title"), F.concat(F.lit("<!-- stamp: "), "stamp", F.lit(" -->\n")),
        F.concat(F.lit("## Purpose\n\n"), cell(F.col("purpose")), F.lit("\n")), F.concat(F.lit("## Narrative\n\n"), cell(F.col("narrative")), F.lit("\n")),
        F.concat(F.lit("## Questions\n\n"), _bullets(F.col("questions"), "- none"), F.lit("\n")), F.concat(F.lit("## Depends on\n\n"), _bullets(F.col("dependencies"), "- none"), F.lit("\n")),
        F.concat(F.lit("## Coverage\n\n| unit | title | sub-units | references | primary | secondary | gaps |\n|---|---|---:|---:|---:|---:|---:|\n"), F.coalesce("table", F.lit("")), F.lit("\n")), F.coalesce("units", F.lit("")),
    )
    return rows.select("chapter", text.alias("markdown"))


# ---- coherence ----------------------------------------------------------------------------------


def coherence_report(contradictions: DataFrame, ledger: DataFrame, xrefs: DataFrame, exemplars: DataFrame, shown: int = SHOWN) -> DataFrame:
    """One row (markdown, and counts): what chapters contradict, repeat, use too early and point to wrongly.  Each part lists
    at most `shown` items, a report's length; the counts are of all.

    contradictions as conflicts() gives them; ledger as concept_ledger(); xrefs as cross_references(); exemplars as style_exemplars().
    """
    def part(df: DataFrame, order: list, line: Column, name: str) -> DataFrame:
        top = df.orderBy(*order).limit(shown).select(F.struct(*[c if isinstance(c, Column) else F.col(c) for c in order]).alias("o"), line.alias("line"))
        lines = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda x: x["line"]), "\n").alias(name))
        return df.agg(F.count("*").alias(f"n_{name}")).crossJoin(lines)

    sides = F.array_join(F.transform("sides", lambda s: F.concat(F.lit("    - `"), F.substring(s["object"], 1, 90), F.lit("`, chapters "), F.array_join(F.transform(s["chapters"], lambda x: x.cast("string")), ", "))), "\n")
    con = part(contradictions, ["subject_entity", "relation"], F.concat(F.lit("- **"), F.col("subject_entity").cast("string"), F.lit("**: "), "relation", F.lit("\n"), sides), "contradictions")
    entity = F.concat(F.lit("- **"), F.col("entity_id").cast("string"), F.lit("**"))
    red = part(ledger.filter("redundant"), ["entity_id"], F.concat(entity, F.lit(" explained in "), F.col("n_substantive").cast("string"), F.lit(" chapters, mentioned in "), F.col("n_mentioned").cast("string")), "redundant")
    fwd = part(ledger.filter("forward"), ["entity_id"], F.concat(entity, F.lit(" first mentioned in chapter "), F.col("first_mention").cast("string"), F.lit(", first explained in chapter "), F.col("first_substantive").cast("string")), "forward")
    ref = part(xrefs.filter("problem is not null"), ["chapter", "pos"], F.concat(F.lit("- chapter "), F.col("chapter").cast("string"), F.lit(": **"), "problem", F.lit("**: \""), "phrase", F.lit("\"")), "xrefs")
    exa = part(exemplars, ["chapter", "rank"], F.concat(F.lit("> (chapter "), F.col("chapter").cast("string"), F.lit(") "), F.substring("paragraph", 1, 280)), "exemplars")
    rows = con.crossJoin(red).crossJoin(fwd).crossJoin(ref).crossJoin(exa)  # one row each
    section = lambda title, name: F.concat(F.lit(f"## {title} ("), F.col(f"n_{name}").cast("string"), F.lit(")\n\n"), F.coalesce(F.nullif(name, F.lit("")), F.lit("None.")), F.lit("\n"))
    text = F.concat_ws(
        "\n", F.lit("# Coherence of chapters\n"), section("Contradictions", "contradictions"), section("Explained again and again", "redundant"), section("Used before it is explained", "forward"),
        section("References that lead nowhere", "xrefs"), section("Candidates for style", "exemplars"),
    )
    return rows.select(text.alias("markdown"), *[f"n_{n}" for n in ("contradictions", "redundant", "forward", "xrefs", "exemplars")])


# ---- runs and pages -----------------------------------------------------------------------------


def run_summary(stages: DataFrame) -> DataFrame:
    """(run_id, text) of run records: a line a stage with its status, time and metrics, then the time in all."""
    metrics = F.array_join(F.array_sort(F.transform(F.map_entries("metrics"), lambda e: F.concat_ws("=", e["key"], e["value"]))), " ")
    line = F.concat_ws(" ", F.rpad("name", 18, " "), F.rpad("status", 5, " "), F.concat(F.format_number("seconds", 1), F.lit("s")), metrics)
    worst = F.when(F.max((F.col("status") == "fail").cast("int")) == 1, "fail").when(F.max((F.col("status") == "warn").cast("int")) == 1, "warn").otherwise("ok")
    rows = stages.groupBy("run_id", "chapter").agg(_lines("idx", line).alias("lines"), worst.alias("worst"), F.sum("seconds").alias("total"))
    head = F.concat(F.lit("run "), "run_id", F.lit(", chapter "), F.col("chapter").cast("string"), F.lit(": "), "worst")
    return rows.select("run_id", F.concat_ws("\n", head, "lines", F.concat(F.lit("total "), F.format_number("total", 1), F.lit("s"))).alias("text"))


def page_results(pages: DataFrame, errors: DataFrame) -> DataFrame:
    """(source, markdown): pages (source, page, text) in order, a table of states, and errors (source, page, message)."""
    body = F.concat(F.lit("## Page "), F.col("page").cast("string"), F.lit("\n\n"), "text")
    good = pages.groupBy("source").agg(_lines("page", body, "\n\n").alias("pages"), _lines("page", F.concat(F.lit("| "), F.col("page").cast("string"), F.lit(" | ok |"))).alias("ok"))
    bad = errors.groupBy("source").agg(_lines("page", F.concat(F.lit("| "), F.col("page").cast("string"), F.lit(" | "), F.translate("message", "|\n", "/ "), F.lit(" |"))).alias("bad"))
    rows = good.join(bad, "source", "full_outer")
    table = F.concat(F.lit("| page | state |\n|---:|---|\n"), F.concat_ws("\n", "ok", "bad"))
    return rows.select("source", F.concat_ws("\n\n", table, "pages").alias("markdown"))


def repair_prompts(sections: DataFrame, verdicts: DataFrame, ungrounded: DataFrame, most_terms: int = 40) -> DataFrame:
    """(section, prompt): what to mend in a section, contradictions first; sections without problems have none.

    sections (section, text); verdicts (section, claim_id, text, verdict, conflict, missing); ungrounded (section, term, rank).
    """
    v = F.lower("verdict")
    order = F.when(v == "contradicted", 0).when(v == "unsupported", 1).when(v == "partial", 2)
    quoted = F.concat(F.lit('"'), "text", F.lit('"'))
    line = (
        F.when(v == "contradicted", F.concat(F.lit("- CONTRADICTED: "), quoted, F.lit("\n  the sources say: "), F.coalesce("conflict", F.lit("see the evidence"))))
        .when(v == "unsupported", F.concat(F.lit("- UNSUPPORTED: "), quoted, F.lit("\n  nothing in the evidence shows it"), F.coalesce(F.concat(F.lit(" ("), "missing", F.lit(")")), F.lit(""))))
        .when(v == "partial", F.concat(F.lit("- PARTLY UNSUPPORTED: "), quoted, F.lit("\n  not shown: "), F.coalesce("missing", F.lit("unclear"))))
    )
    problems = verdicts.withColumn("o", order).filter("o is not null").groupBy("section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "claim_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("problems"))
    terms = ungrounded.filter(F.col("rank") <= most_terms).groupBy("section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("terms"))
    rows = sections.join(problems, "section", "left").join(terms, "section", "left").filter("problems is not null or terms is not null")
    named = F.concat(F.lit("- In no evidence, remove or hedge: "), "terms")
    return rows.select("section", F.concat_ws("\n", F.lit("PROBLEMS FOUND:"), "problems", named, F.lit("\nSECTION TO REVISE:\n"), "text").alias("prompt"))


def citation_metrics(sections: DataFrame) -> DataFrame:
    """(section, n_sentences, n_cited, completeness, uncited_factual): how much of a text cites; sections (section, text)."""
    from .coherence import sentences

    cites = lambda s: s.rlike(r"\[E\d+\]|\[\d+\]")
    factual = lambda s: s.rlike(r"\d|[\p{Lu}][\p{Ll}]{2,}")
    rows = sections.select("section", sentences(F.col("text")).alias("s"))
    n, cited = F.size("s"), F.size(F.filter("s", cites))
    share = F.when(n == 0, 1.0).otherwise(F.bround(cited / n, 4))
    return rows.select("section", n.alias("n_sentences"), cited.alias("n_cited"), share.alias("completeness"), F.size(F.filter("s", lambda s: ~cites(s) & factual(s))).alias("uncited_factual"))


def chapter_evaluation(chapters: DataFrame, passages: DataFrame, aliases: DataFrame) -> DataFrame:
    """(chapter, words, ungrounded_terms, truncated, gaps, unresolved, and citation metrics): what can be counted without a judge.

    chapters (chapter, text); passages (chapter, text).
    """
    from .grounding import GAP, cited_ids, ungrounded

    text = tx.empty_if_null(F.col("text"))
    main = F.element_at(F.split(text, "## Notes"), 1)
    base = chapters.select(
        "chapter", F.size(F.filter(F.split(text, r"\s+"), lambda x: x != "")).alias("words"), ((F.rtrim(text) != "") & ~F.rtrim(text).rlike(r"[.!?\"')\]}]$")).alias("truncated"),
        F.regexp_count(text, F.lit(GAP)).alias("gaps"), F.size(F.array_distinct(cited_ids(main))).alias("unresolved"),
    )
    missing = ungrounded(chapters.select(F.col("chapter").alias("sub"), "text"), passages.select(F.col("chapter").alias("sub"), "text"), aliases).groupBy(F.col("sub").alias("chapter")).agg(F.count("*").alias("ungrounded_terms"))
    cited = citation_metrics(chapters.select(F.col("chapter").alias("section"), "text")).withColumnRenamed("section", "chapter")
    return base.join(missing, "chapter", "left").fillna(0, ["ungrounded_terms"]).join(cited, "chapter")
