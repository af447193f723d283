"""Passes of a model over rows: prompts are columns, replies are typed columns, failures are rows with a status.

Each pass takes a factory of clients (models.ModelClient).  What a reply must hold is checked with columns after
it was parsed; nothing that a model says is taken without that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from ..functions import text as tx
from . import claims as cl, cleaning, drafting, entities as en, grounding as gr, models
from .numbering import numbered

Client = Callable[[], models.ModelClient]
ENTITY_TYPES = ("person", "place", "dynasty", "work", "deity", "structure", "inscription", "term", "other")
WORK_KINDS = ("book", "article", "edition", "report", "inscription", "unknown")


def asked(rows: DataFrame, prompt: Column, schema: str, client: Client, to: str = "answer", **options) -> DataFrame:
    """rows with the answer, of the given type, and its status; an answer that doesn't fit the type is null."""
    replies = models.complete(rows.withColumn("_prompt", prompt), client, "_prompt", "_reply", as_json=True, **options)
    return replies.withColumn(to, F.from_json("_reply", schema)).withColumn(f"{to}_status", F.col("_reply_status")).drop("_prompt", "_reply", "_reply_status")


def told(rows: DataFrame, prompt: Column, client: Client, to: str = "answer", **options) -> DataFrame:
    """rows with a text as answer."""
    return models.complete(rows.withColumn("_prompt", prompt), client, "_prompt", to, **options).drop("_prompt")


def _prompt(task: str, *parts: Column) -> Column:
    return F.concat_ws("\n\n", F.lit(task), *parts)


def _part(name: str, c: Column) -> Column:
    return F.concat(F.lit(f"{name}:\n"), c)


def _batched(rows: DataFrame, by: str, size: int, item: Column) -> DataFrame:
    """(batch, items, listing): items of so many rows, in order, and their JSON with places from 0.  Rows are numbered by ranges, in no one task."""
    names, n = rows.columns, F.col("_number")
    grouped = numbered(rows.select(*names), [by], name="_number", start=0).withColumn("batch", F.floor(n / size).cast("int")).withColumn("i", (n % size).cast("int"))
    listed = F.array_sort(F.collect_list(F.struct("i", F.struct(item.alias("x"), *[F.col(c) for c in names]).alias("row"))))
    return grouped.groupBy("batch").agg(listed.alias("items")).withColumn("listing", F.to_json(F.transform("items", lambda x: F.struct(x["i"].alias("i"), x["row"]["x"].alias("x")))))


# ---- entities and claims ------------------------------------------------------------------------


def proposed_entities(candidates: DataFrame, registry: DataFrame, client: Client, batch: int = 120) -> tuple[DataFrame, DataFrame]:
    """New entities (entity_id, canonical, type, aliases, curated) and new aliases (entity_id, alias) for candidate terms (term, n).

    A proposal is taken if its type is known and no entity has its name.
    """
    rows = _batched(candidates, "term", batch, F.concat_ws(" ", F.col("term"), F.concat(F.lit("("), F.col("n").cast("string"), F.lit(")"))))
    known = registry.agg(F.to_json(F.array_sort(F.collect_list(F.struct("entity_id", "canonical", "type")))).alias("known"))
    schema = "struct<new:array<struct<canonical:string,type:string,aliases:array<string>>>,add_aliases:array<struct<id:string,aliases:array<string>>>>"
    task = f"Group these surface forms into entities of the types {', '.join(ENTITY_TYPES)}, or as aliases of known ones. Answer in JSON: new, add_aliases."
    got = asked(rows.crossJoin(known), _prompt(task, _part("KNOWN", F.col("known")), _part("FORMS", F.col("listing"))), schema, client).select("answer")
    aliases = en.aliases(en.normalised_registry(registry))
    new = got.select(F.explode("answer.new").alias("e")).select(F.trim("e.canonical").alias("canonical"), F.trim("e.type").alias("type"), F.coalesce("e.aliases", F.array().cast("array<string>")).alias("aliases"))
    new = new.filter(F.col("type").isin(*ENTITY_TYPES) & (F.coalesce("canonical", F.lit("")) != "")).dropDuplicates(["canonical"])
    fresh = en.resolve(new.withColumn("term", F.col("canonical")), aliases).filter("entity_id is null").select("canonical", "type", "aliases")
    added = got.select(F.explode("answer.add_aliases").alias("a")).select(F.col("a.id").alias("entity_id"), F.explode("a.aliases").alias("alias"))
    have = registry.select("entity_id", F.explode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    return en.next_ids(fresh, registry).withColumn("curated", F.lit(False)), added.join(registry.select("entity_id"), "entity_id", "left_semi").join(have, ["entity_id", "alias"], "left_anti").distinct()


CLAIMS = "struct<claims:array<struct<subject:string,predicate:string,object:string,type:string,confidence:double>>>"
EXTRACT = "List the atomic claims of this text in JSON: claims, each with subject, predicate, object, type and confidence."


def _claims(replies: DataFrame, aliases: DataFrame, keep: list[str]) -> DataFrame:
    rows = replies.select(*keep, F.explode("answer.claims").alias("c"))
    rows = rows.select(*keep, F.trim("c.subject").alias("term"), F.trim("c.predicate").alias("predicate"), F.trim(F.coalesce("c.object", F.lit(""))).alias("object"), F.col("c.type").alias("claim_type"), F.coalesce("c.confidence", F.lit(0.7)).alias("confidence"))
    rows = rows.filter("term <> '' and predicate <> ''")
    out = en.resolve(rows, aliases).withColumn("subject_entity", F.coalesce("entity_id", "term")).drop("term", "entity_id")
    return cl.with_claim_ids(out).dropDuplicates(["claim_id"])


def claims_of_chunks(chunks: DataFrame, aliases: DataFrame, client: Client) -> DataFrame:
    """Claims of rows (rowid, source, trail, text, page_start, page_end), subjects resolved where the registry knows them."""
    prompt = _prompt(EXTRACT, _part("SOURCE", F.col("source")), _part("SECTION", tx.empty_if_null(F.col("trail"))), F.substring("text", 1, 2400))
    rows = asked(chunks, prompt, CLAIMS, client).select(F.lit("corpus").alias("scope"), "source", F.col("rowid").alias("chunk_id"), "page_start", "page_end", F.lit(None).cast("int").alias("chapter"), "answer")
    return _claims(rows, aliases, ["scope", "source", "chunk_id", "page_start", "page_end", "chapter"])


def claims_of_manuscript(chapters: DataFrame, aliases: DataFrame, client: Client, size: int = 9000) -> DataFrame:
    """Claims of chapters (chapter, text), a segment at a time; they replace the scope 'manuscript' as a whole."""
    main = F.element_at(F.split(tx.empty_if_null(F.col("text")), "## Notes"), 1)
    rows = chapters.select("chapter", F.explode(drafting.segments(main, size)).alias("segment"))
    got = asked(rows, _prompt(EXTRACT, F.concat(F.lit("CHAPTER "), F.col("chapter").cast("string")), F.col("segment")), CLAIMS, client)
    name = F.concat(F.lit("chapter-"), F.lpad(F.col("chapter").cast("string"), 2, "0"))
    rows = got.select(F.lit("manuscript").alias("scope"), name.alias("source"), F.col("chapter").cast("long").alias("chunk_id"), F.lit(None).cast("int").alias("page_start"), F.lit(None).cast("int").alias("page_end"), "chapter", "answer")
    return _claims(rows, aliases, ["scope", "source", "chunk_id", "page_start", "page_end", "chapter"])


# ---- bibliography, dossiers, preambles ----------------------------------------------------------


def resolved_entries(entries: DataFrame, client: Client, batch: int = 8) -> DataFrame:
    """entries (entry_id, source, chunk_id, raw) with resolved, work_id, author, title, year, publisher and kind.

    resolved: 1 where the model named an author or a title, -1 where it answered with neither (no entry), 0 where it didn't
    answer, which is tried again.
    """
    rows = _batched(entries.select("entry_id", "source", "chunk_id", "raw"), "entry_id", batch, F.substring("raw", 1, 320))
    schema = "struct<results:array<struct<i:int,author:string,title:string,year:int,publisher:string,kind:string>>>"
    got = asked(rows, _prompt("Split each entry into author, title, year, publisher and kind. Answer in JSON: results, with the place i of each.", F.col("listing")), schema, client)
    each = got.select("answer", F.explode("items").alias("item"))
    each = each.select(*[F.col(f"item.row.{c}").alias(c) for c in ("entry_id", "source", "chunk_id", "raw")], F.try_element_at(F.filter("answer.results", lambda r: r["i"] == F.col("item.i")), F.lit(-1)).alias("r"))
    author, title = (F.nullif(F.trim(F.coalesce(F.col(f"r.{c}"), F.lit(""))), F.lit("")) for c in ("author", "title"))
    named = author.isNotNull() | title.isNotNull()
    state = F.when(F.col("r").isNull(), 0).when(named, 1).otherwise(-1)
    kind = F.when(F.col("r.kind").isin(*WORK_KINDS), F.col("r.kind")).otherwise("unknown")
    out = each.withColumns({"resolved": state, "author": author, "title": title, "year": F.col("r.year"), "publisher": F.col("r.publisher"), "kind": kind}).drop("r")
    return out.withColumn("work_id", F.when(F.col("resolved") == 1, tx.work_key(F.col("author"), F.col("title"), F.col("year"))))


NOTES = "struct<sections:array<string>,observations:array<string>>"
DOSSIER = (
    "struct<identity:struct<author:string,title:string,year:int,publisher:string,edition:string>,kind:string,genre:string,coverage:struct<period_from:int,period_to:int,geography:array<string>,monuments:array<string>>,"
    "stance:string,reliability_notes:array<string>,summary:string,key_claims:array<string>,caveats:array<string>>"
)


def window_notes(docs: DataFrame, client: Client, id_col: str = "source", text_col: str = "text", limit: int = 60_000, sections: int = 200, observations: int = 300) -> DataFrame:
    """(source, sections, observations): what a model notes in the windows of each text, joined in order."""
    rows = cleaning.text_windows(docs, id_col, text_col, limit)
    got = asked(rows, _prompt("List the sections of this text and what there is to note, in JSON: sections, observations.", F.col("text")), NOTES, client)
    joined = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("window", F.coalesce(f"answer.{c}", F.array().cast("array<string>")).alias("v")))), lambda x: x["v"]))
    out = got.groupBy(F.col("doc").alias("source")).agg(joined("sections").alias("sections"), joined("observations").alias("observations"))
    return out.select("source", F.slice("sections", 1, sections).alias("sections"), F.slice("observations", 1, observations).alias("observations"))


def built_dossiers(notes: DataFrame, client: Client, cached: DataFrame | None = None) -> DataFrame:
    """(source, status, dossier fields): a nested record of each source from its notes; sources that are cached are not asked again."""
    rows = notes if cached is None else notes.join(cached.select("source"), "source", "left_anti")
    prompt = _prompt("Describe this source in JSON: identity, kind, genre, coverage, stance, reliability_notes, summary, key_claims, caveats.", _part("SOURCE", F.col("source")), _part("NOTES", F.to_json(F.struct("sections", "observations"))))
    got = asked(rows.select("source", "sections", "observations"), prompt, DOSSIER, client).select("source", F.col("answer_status").alias("status"), "answer.*")
    return got if cached is None else got.unionByName(cached, allowMissingColumns=True)


def preambles(chunks: DataFrame, dossiers: DataFrame, client: Client, enforce: bool = True) -> DataFrame:
    """chunks (rowid, source, trail, text, page_start, page_end) with context, how (llm, rejected or fallback) and rejected terms.

    A preamble that names what neither the passage nor what is known of its source does is rejected for the one from metadata.
    """
    d = dossiers.select("source", F.col("identity.title").alias("_title"), "genre", "stance", "summary")
    rows = chunks.join(d, "source", "left")
    known = F.to_json(F.struct("source", "_title", "genre", F.substring("stance", 1, 400).alias("stance"), F.substring("summary", 1, 1200).alias("summary")))
    prompt = _prompt("Say in a sentence or two where this passage stands and what it is about, from what is given alone, in JSON: context.", _part("SOURCE", known), _part("SECTION", tx.empty_if_null(F.col("trail"))), _part("PASSAGE", F.substring("text", 1, 2400)))
    got = asked(rows, prompt, "struct<context:string>", client)
    said = F.trim(F.regexp_replace(tx.empty_if_null(F.col("answer.context")), r"\s+", " "))
    told_ = [F.col(c) for c in ("text", "source", "trail", "_title", "genre", "stance", "summary")]
    names, numbers = gr.new_facts(said, drafting.allowed_vocabulary(*told_), F.array_distinct(F.flatten(F.array(*[tx.numerals(c) for c in told_]))))
    got = got.withColumn("_said", said).withColumn("rejected", F.concat(names, numbers) if enforce else F.array().cast("array<string>"))
    plain = drafting.context_sentence(F.coalesce("_title", "source"), F.col("genre"), F.col("trail"), F.col("page_start"), F.col("page_end"))
    how = F.when(F.col("_said") == "", "fallback").when(F.size("rejected") > 0, "rejected").otherwise("llm")
    out = got.withColumn("how", how).withColumn("context", F.when(F.col("how") == "llm", F.col("_said")).otherwise(plain))
    return out.select(*chunks.columns, "context", "how", F.when(F.col("how") == "rejected", F.col("rejected")).otherwise(F.array().cast("array<string>")).alias("rejected"))


def save_contexts(contexts: DataFrame, path: str) -> None:
    """Append preambles (rowid, context, how, rejected) of a batch; a run that starts again takes what is there (missing_contexts)."""
    contexts.select("rowid", "context", "how", "rejected").write.mode("append").parquet(path)


def missing_contexts(chunks: DataFrame, saved: DataFrame) -> DataFrame:
    return chunks.join(saved.select("rowid").distinct(), "rowid", "left_anti")


# ---- queries and plans --------------------------------------------------------------------------


def expanded_queries(subs: DataFrame, client: Client, most: int = 3) -> DataFrame:
    """subs (chapter, title, scope, key, question, anchor) with queries: the plain ones, then up to `most` of the model's.

    One call a chapter; where it fails the plain ones are all there is.
    """
    listing = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "question"))), lambda x: F.concat(F.lit("- "), x["key"], F.lit(": "), x["question"])), "\n")
    chapters = subs.groupBy("chapter", "title", "scope").agg(listing.alias("listing"))
    prompt = _prompt("For each sub-topic give up to three queries that a source would match, in JSON by key.", _part("CHAPTER", F.col("title")), _part("SCOPE", F.col("scope")), _part("SUB-TOPICS", F.col("listing")))
    got = asked(chapters, prompt, "map<string,array<string>>", client).select("chapter", "answer", "answer_status")
    plain = drafting.deterministic_queries(F.col("question"), F.col("anchor"))
    more = F.slice(F.coalesce(F.try_element_at("answer", F.col("key")), F.array().cast("array<string>")), 1, most)
    return subs.join(got, "chapter", "left").withColumn("queries", drafting.query_union(plain, more)).drop("answer").withColumnRenamed("answer_status", "expansion_status")


HIERARCHY = "struct<purpose:string,narrative:string,questions:array<string>,dependencies:array<string>,units:array<struct<title:string,subs:array<string>>>>"


def expanded_plans(outline: DataFrame, client: Client) -> DataFrame:
    """outline (chapter, title, theme, scope, subtopics) with a plan of units and sub-units, and its status.

    A reply that ends too early is called truncated and gives no plan, rather than half of one.
    """
    prompt = _prompt("Plan this chapter in units and sub-units, in JSON: purpose, narrative, questions, dependencies, units with title and subs.", _part("CHAPTER", F.col("title")), _part("SCOPE", F.col("scope")), _part("SUB-TOPICS", F.array_join("subtopics", "\n")))
    return asked(outline, prompt, HIERARCHY, client, "plan", repairs=8)


def drafted_sections(sections: DataFrame, client: Client, continuations: int = 3) -> DataFrame:
    """sections (chapter, section, title, brief, evidence, words) with draft and draft_status; what ends for its length is gone on with."""
    task = "Write this section from its evidence alone. Cite as [E1]. Where the evidence lacks what is needed write [GAP: not in the sources]."
    prompt = _prompt(task, _part("SECTION", F.col("title")), _part("WORDS", F.col("words").cast("string")), _part("BRIEF", F.col("brief")), _part("EVIDENCE", F.col("evidence")))
    return told(sections, prompt, client, "draft", continuations=continuations)


def edited_sections(sections: DataFrame, client: Client, chars: int = 700, max_growth: float = 1.15) -> DataFrame:
    """sections (chapter, section, text) with edited: smoothed against their neighbours, where the edit is acceptable."""
    rows = drafting.with_neighbours(sections, chars)
    prompt = _prompt("Smooth this section into its neighbours. Keep facts, headings and citation marks.", _part("BEFORE", tx.empty_if_null(F.col("before"))), _part("SECTION", F.col("text")), _part("AFTER", tx.empty_if_null(F.col("after"))))
    got = told(rows, prompt, client, "_edit")
    same = F.array_sort(gr.cited_ids(F.col("text"))) == F.array_sort(gr.cited_ids(F.col("_edit")))
    ok = F.coalesce((F.col("_edit_status") == "ok") & gr.edit_accepted(F.col("text"), F.col("_edit"), max_growth) & same, F.lit(False))
    return got.withColumn("accepted", ok).withColumn("edited", F.when(ok, F.col("_edit")).otherwise(F.col("text"))).drop("_edit", "_edit_status", "before", "after")


# ---- verification and evaluation ----------------------------------------------------------------


def decomposed(sections: DataFrame, client: Client, words: int = 550) -> DataFrame:
    """(section, claim_id, text, kind, quote): claims of each section, numbered over all of its windows."""
    rows = cleaning.text_windows(sections, "section", "text", words, "paragraphs")
    got = asked(rows, _prompt("List the atomic claims of this text in JSON: claims, each with text, kind and quote.", F.col("text")), "struct<claims:array<struct<text:string,kind:string,quote:string>>>", client)
    each = got.select(F.col("doc").alias("section"), "window", F.posexplode("answer.claims").alias("pos", "c")).filter("coalesce(c.text, '') <> ''")
    number = F.row_number().over(W.partitionBy("section").orderBy("window", "pos"))
    return each.select("section", number.alias("claim_id"), "c.text", F.coalesce("c.kind", F.lit("factual")).alias("kind"), F.coalesce("c.quote", F.lit("")).alias("quote"))


def entailed(claims_: DataFrame, passages: DataFrame, client: Client, batch: int = 12) -> DataFrame:
    """claims (section, claim_id, text) with verdict, missing and conflict; what isn't answered is unverified, never supported.

    passages (section, pos, id, source, text) are what claims are checked against.
    """
    item = F.concat(F.lit("["), "id", F.lit("] ("), "source", F.lit(")\n"), F.substring("text", 1, 1800))
    listing = F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("t")))), lambda x: x["t"]), "\n\n"), 1, 60_000)
    evidence = passages.groupBy("section").agg(listing.alias("evidence"))
    group = F.floor((F.row_number().over(W.partitionBy("section").orderBy("claim_id")) - 1) / batch)
    grouped = claims_.withColumn("_g", group).groupBy("section", "_g").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("claim_id").alias("id"), "text")))).alias("listing"))
    schema = "struct<results:array<struct<id:int,verdict:string,missing:string,conflict:string>>>"
    task = f"Judge each claim by the passages alone: {', '.join(gr.VERDICTS[:4])}. Answer in JSON: results, each with id, verdict, missing and conflict."
    got = asked(grouped.join(evidence, "section", "left"), _prompt(task, _part("PASSAGES", tx.empty_if_null(F.col("evidence"))), _part("CLAIMS", F.col("listing"))), schema, client)
    results = got.select("section", F.explode("answer.results").alias("r")).select("section", F.col("r.id").alias("claim_id"), "r.verdict", "r.missing", "r.conflict").dropDuplicates(["section", "claim_id"])
    rows = claims_.join(results, ["section", "claim_id"], "left")
    return rows.withColumn("verdict", F.when(F.lower("verdict").isin(*gr.VERDICTS), F.lower("verdict")).otherwise("unverified"))


def answer_relevance(chapters: DataFrame, questions: DataFrame, client: Client) -> DataFrame:
    """(chapter, relevance): the mean of a judge's scores of how fully a chapter answers its questions, 0 to 1; null without any."""
    q = questions.groupBy("chapter").agg(F.to_json(F.array_sort(F.collect_list(F.struct("pos", "question")))).alias("questions"))
    rows = chapters.join(q, "chapter")
    got = asked(rows, _prompt("Score 0 to 100 how fully the chapter answers each question, in JSON: scores, each with i and s.", _part("QUESTIONS", F.col("questions")), _part("CHAPTER", F.substring("text", 1, 30_000))), "struct<scores:array<struct<i:int,s:double>>>", client)
    s = F.col("answer.scores")
    mean = F.when(F.size(s) > 0, F.bround(F.aggregate(s, F.lit(0.0), lambda a, x: a + x["s"] / 100) / F.size(s), 4))
    return chapters.select("chapter").join(got.select("chapter", mean.alias("relevance")), "chapter", "left")


def negatives(chunks: DataFrame, client: Client, n: int = 8) -> DataFrame:
    """Gold items that nothing should be found for: (question, relevant_chunks, reference_facts, expected_empty, kind, verified, notes)."""
    listing = chunks.agg(F.array_join(F.array_sort(F.collect_set(F.translate(F.regexp_replace("source", r"\.md$", ""), "-", " "))), "; ").alias("sources"))
    prompt = _prompt(f"Write {n} questions of this field that the corpus can't answer, in JSON: questions, each with question and why_absent.", _part("CORPUS", F.col("sources")))
    got = asked(listing, prompt, "struct<questions:array<struct<question:string,why_absent:string>>>", client)
    rows = got.select(F.explode(F.slice(F.filter("answer.questions", lambda q: F.coalesce(q["question"], F.lit("")) != ""), 1, n)).alias("q"))
    return rows.select(
        "q.question", F.array().cast("array<bigint>").alias("relevant_chunks"), F.array().cast("array<string>").alias("reference_facts"), F.lit(True).alias("expected_empty"),
        F.lit("expected_empty").alias("kind"), F.lit(False).alias("verified"), F.coalesce("q.why_absent", F.lit("")).alias("notes"),
    )


def content_labels(chunks: DataFrame, categories: tuple[str, ...], roles: tuple[str, ...], client: Client, batch: int = 8) -> DataFrame:
    """(chunk_id, content, evidence_role): up to three known categories and a known role or null; rows that weren't answered are absent."""
    rows = _batched(chunks.select("rowid", "text"), "rowid", batch, F.substring("text", 1, 1500))
    schema = "struct<results:array<struct<i:int,content:array<string>,role:string>>>"
    got = asked(rows, _prompt(f"Label each passage with up to three of {', '.join(categories)} and a role of {', '.join(roles)}, in JSON: results.", F.col("listing")), schema, client)
    each = got.select("items", F.explode("answer.results").alias("r"))
    row = F.try_element_at(F.filter("items", lambda x: x["i"] == F.col("r.i")), F.lit(-1))
    each = each.select(row.alias("x"), "r").filter("x is not null")
    return each.select(F.col("x.row.rowid").alias("chunk_id"), models.valid_categories(F.col("r.content"), categories).alias("content"), F.when(F.col("r.role").isin(*roles), F.col("r.role")).alias("evidence_role"))
