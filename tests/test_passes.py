"""Model passes with clients that answer by rule, reports, source records, pages, transliteration."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import text as tx
from quarry.operators import entities as en, evaluation as ev, models, passes as ps, reports as rp, store
from quarry.sources import ocr


# Clients of this module go to workers as they are, for workers can't import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Rules:
    """Answers by what a prompt holds; a prompt with none of the marks fails."""

    def __init__(self, rules):
        self.rules = rules

    def complete(self, prompts):
        out = []
        for p in prompts:
            for mark, answer in self.rules:
                if mark in p:
                    out.append(answer if isinstance(answer, str) else json.dumps(answer))
                    break
            else:
                raise RuntimeError("401 refused")
        return out


def rules(*pairs):
    return lambda: Rules(pairs)


REGISTRY = [("E:PERSON:001", "Bhoja", "person", ["Bhojadeva"], True), ("E:PLACE:001", "Dhar", "place", [], True)]


@pytest.fixture()
def registry(spark):
    return spark.createDataFrame(REGISTRY, "entity_id string, canonical string, type string, aliases array<string>, curated boolean")


@pytest.fixture()
def aliases(registry):
    return en.aliases(en.normalised_registry(registry))


# ---- calls --------------------------------------------------------------------------------------


def test_errors_are_told_apart():
    cases = {
        "429 Too Many Requests": (True, True, False), "rate_limit exceeded": (True, True, False), "429: monthly quota exhausted": (False, False, True), "HTTP 401": (False, False, True), "403 forbidden": (False, False, True),
        "500 internal error": (False, False, False), "503 service unavailable": (True, False, False), "connection reset": (True, False, False), "no capacity": (False, False, True), "bad request": (False, False, False),
    }
    assert {m: models.classify_error(m) for m in cases} == cases


def test_error_columns(spark):
    rows = spark.createDataFrame([("429 slow",), ("quota",), ("timed out",), ("bad",)], "m string")
    assert [r[0] for r in rows.select(models.error_class(F.col("m"))).collect()] == ["throttled", "quota", "transient", "fatal"]


def test_the_server_is_obeyed():
    now, slept = [0.0], []
    limiter = models.RateLimiter(1.0, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    answers = [RuntimeError("429 retry-after: 17"), RuntimeError("429"), "good"]

    def fn():
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return [a]

    assert models.called(fn, limiter, sleep=lambda s: slept.append(s)) == ["good"]
    assert slept[0] == pytest.approx(17) and limiter.throttles == 2 and limiter.rate == 0.25
    with pytest.raises(models.QuotaError):
        models.called(lambda: (_ for _ in ()).throw(RuntimeError("billing")), limiter, sleep=lambda s: None)


def test_parallel_keeps_order():
    assert models.in_parallel(lambda x: x * x, list(range(20)), 5) == [x * x for x in range(20)]
    assert models.in_parallel(lambda x: 1 // x, [1, 0, 2], 3, lambda j, e: (j, type(e).__name__)) == [1, (0, "ZeroDivisionError"), 0]


class Long:
    def complete(self, prompts):
        raise AssertionError("finish is asked")

    def finish(self, prompts):
        return [("the end.", "stop") if models.CONTINUE in p else ("It goes on to", "length") for p in prompts]


def test_continuation(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "prompt string")
    got = models.complete(rows, Long, continuations=3).collect()
    assert [r["reply"] for r in got] == ["It goes on to the end."] * 3 and {r["reply_status"] for r in got} == {"ok"}


# ---- passes -------------------------------------------------------------------------------------


def test_entity_proposals(spark, registry):
    terms = spark.createDataFrame([("Udaya", 9), ("Ganga", 8), ("Bhoja", 4)], "term string, n long")
    answer = {"new": [{"canonical": "Ganga", "type": "place", "aliases": ["Gangā"]}, {"canonical": "Bhoja", "type": "person"}, {"canonical": "X", "type": "planet"}], "add_aliases": [{"id": "E:PLACE:001", "aliases": ["Dhara", "Dhar"]}, {"id": "E:NO:1", "aliases": ["z"]}]}
    new, added = ps.proposed_entities(terms, registry, rules(("FORMS", answer)))
    assert [(r["entity_id"], r["canonical"], r["curated"]) for r in new.collect()] == [("E:PLACE:002", "Ganga", False)]
    assert [tuple(r) for r in added.collect()] == [("E:PLACE:001", "Dhara")]


def test_claims(spark, aliases):
    chunks = spark.createDataFrame([(1, "s.md", "T", "good text", 3, 4), (2, "s.md", None, "bad text", None, None)], "rowid long, source string, trail string, text string, page_start int, page_end int")
    answer = {"claims": [{"subject": " Bhojadeva ", "predicate": "ruled", "object": "Dhar", "type": "fact"}, {"subject": "", "predicate": "x"}, {"subject": "Nobody", "predicate": "was", "type": "odd", "confidence": 0.2}]}
    rows = {r["predicate"]: r for r in ps.claims_of_chunks(chunks, aliases, rules(("good text", answer))).collect()}
    assert set(rows) == {"ruled", "was"} and rows["ruled"]["subject_entity"] == "E:PERSON:001" and rows["was"]["subject_entity"] == "Nobody"
    assert rows["ruled"]["confidence"] == 0.7 and rows["was"]["claim_type"] == "interpretation" and rows["ruled"]["chunk_id"] == 1
    chapters = spark.createDataFrame([(4, "a" * 9001 + "\n## Notes\n[1] no")], "chapter int, text string")
    got = ps.claims_of_manuscript(chapters, aliases, rules(("CHAPTER 4", answer))).collect()
    assert {r["source"] for r in got} == {"chapter-04"} and {r["scope"] for r in got} == {"manuscript"} and len(got) == 2


def test_bibliography_states(spark):
    entries = spark.createDataFrame([(i, "s.md", i, f"entry {i}") for i in range(10)], "entry_id long, source string, chunk_id long, raw string")
    answer = {"results": [{"i": 0, "author": "Kramrisch, S.", "title": "The Temple", "year": 1946, "kind": "book"}, {"i": 1}]}
    rows = {r["entry_id"]: r for r in ps.resolved_entries(entries, rules(("entry 0", answer))).collect()}
    assert [rows[i]["resolved"] for i in range(10)] == [1, -1, 0, 0, 0, 0, 0, 0, 0, 0] and len(rows) == 10
    assert rows[0]["work_id"].startswith("W:") and rows[0]["kind"] == "book" and rows[1]["work_id"] is None


def test_dossiers_and_preambles(spark):
    docs = spark.createDataFrame([("a.md", "x\n" * 50), ("b.md", "y")], "source string, text string")
    notes = ps.window_notes(docs, rules(("x\nx", {"sections": ["s"], "observations": ["o"]}), ("y", {"sections": ["t"], "observations": []})), limit=40)
    by = {r["source"]: r for r in notes.collect()}
    assert len(by["a.md"]["sections"]) == 2 and by["b.md"]["observations"] == []
    known = ps.built_dossiers(notes, rules(("a.md", {"identity": {"title": "Raja of Dhar"}, "genre": "study"}))).collect()
    assert {r["source"]: r["status"][:5] for r in known} == {"a.md": "ok", "b.md": "error"}
    dossiers = spark.createDataFrame(known, ps.built_dossiers(notes, rules(("", {}))).schema)
    chunks = spark.createDataFrame([(1, "a.md", "Kings", "Bhoja ruled in 1010.", 3, 4), (2, "a.md", None, "It says little.", None, None), (3, "b.md", None, "z", 7, 7)], "rowid long, source string, trail string, text string, page_start int, page_end int")
    said = rules(("Bhoja ruled", {"context": "This tells of the king  Bhoja in 1010."}), ("says little", {"context": "It is about the emperor Akbar and 1556."}))
    got = {r["rowid"]: r for r in ps.preambles(chunks, dossiers, said).collect()}
    assert [got[i]["how"] for i in (1, 2, 3)] == ["llm", "rejected", "fallback"]
    assert got[1]["context"] == "This tells of the king Bhoja in 1010." and set(got[2]["rejected"]) == {"Akbar", "1556"}
    assert got[2]["context"] == "From Raja of Dhar, a study." and got[3]["context"] == "From b.md. Page 7."


def test_saved_contexts(spark, tmp_path):
    c = spark.createDataFrame([(1, "x", "llm", ["a"]), (2, "y", "fallback", [])], "rowid long, context string, how string, rejected array<string>")
    ps.save_contexts(c.filter("rowid = 1"), f"file://{tmp_path}/c")
    assert [r["rowid"] for r in ps.missing_contexts(c, spark.read.parquet(f"file://{tmp_path}/c")).collect()] == [2]


def test_queries_and_plans(spark):
    subs = spark.createDataFrame([(1, "T", "S", "k1", "What was it?", "here"), (1, "T", "S", "k2", "Who?", ""), (2, "U", "S", "k3", "When?", "there")], "chapter int, title string, scope string, key string, question string, anchor string")
    got = {r["key"]: r for r in ps.expanded_queries(subs, rules(("k1: What", {"k1": ["a", "b", "c", "d"], "k2": ["who?"]}))).collect()}
    assert got["k1"]["queries"] == ["What was it?", "What was it? — here", "a", "b", "c"] and got["k2"]["queries"] == ["Who?"]
    assert got["k3"]["queries"] == ["When?", "When? — there"] and got["k3"]["expansion_status"].startswith("error")
    outline = spark.createDataFrame([(1, "T", "th", "sc", ["a"]), (2, "V", "th", "sc", ["b"])], "chapter int, title string, theme string, scope string, subtopics array<string>")
    plans = {r["chapter"]: r for r in ps.expanded_plans(outline, rules(("T\n", {"purpose": "p", "units": [{"title": "u", "subs": ["s"]}]}), ("V\n", '{"purpose": "cut'))).collect()}
    assert plans[1]["plan"]["units"][0]["subs"] == ["s"] and plans[2]["plan"] is None and plans[2]["plan_status"] == "truncated"


def test_drafts(spark):
    s = spark.createDataFrame([(1, 1, "A", "b", "[E1] x", 100)], "chapter int, section int, title string, brief string, evidence string, words int")
    assert ps.drafted_sections(s, Long).first()["draft"] == "It goes on to the end."
    texts = spark.createDataFrame([(1, 1, "One fact [E1]."), (1, 2, "Two [E2]."), (1, 3, "Three.")], "chapter int, section int, text string")
    got = {r["section"]: r for r in ps.edited_sections(texts, rules(("SECTION:\nOne", "A fact [E1]."), ("SECTION:\nTwo", "Lost."))).collect()}
    assert [(got[i]["edited"], got[i]["accepted"]) for i in (1, 2, 3)] == [("A fact [E1].", True), ("Two [E2].", False), ("Three.", False)]


def test_verification(spark):
    sections = spark.createDataFrame([("s1", "First.\n\nSecond."), ("s2", "Third.")], "section string, text string")
    claims = ps.decomposed(sections, rules(("First", {"claims": [{"text": "a", "kind": "factual"}, {"text": ""}]}), ("Second", {"claims": [{"text": "b"}]}), ("Third", {"claims": []})), words=1)
    assert [(r["section"], r["claim_id"], r["text"]) for r in claims.orderBy("claim_id").collect()] == [("s1", 1, "a"), ("s1", 2, "b")]
    many = spark.createDataFrame([("s1", i, f"claim {i}.") for i in range(1, 15)], "section string, claim_id int, text string")
    passages = spark.createDataFrame([("s1", 1, "E1", "x.md", "evidence")], "section string, pos int, id string, source string, text string")
    answer = {"results": [{"id": 1, "verdict": "Supported"}, {"id": 2, "verdict": "contradicted", "conflict": "no"}, {"id": 3, "verdict": "maybe"}]}
    got = {r["claim_id"]: r["verdict"] for r in ps.entailed(many, passages, rules(("claim 1.", answer))).collect()}
    assert got[1] == "supported" and got[2] == "contradicted" and set(got[i] for i in range(3, 15)) == {"unverified"}
    chapters = spark.createDataFrame([(1, "t"), (2, "u")], "chapter int, text string")
    questions = spark.createDataFrame([(1, 0, "q"), (1, 1, "r")], "chapter int, pos int, question string")
    rel = {r["chapter"]: r["relevance"] for r in ps.answer_relevance(chapters, questions, rules(("QUESTIONS", {"scores": [{"i": 0, "s": 80}, {"i": 1, "s": 41}]}))).collect()}
    assert rel == {1: 0.605, 2: None}


def test_negatives_and_labels(spark):
    chunks = spark.createDataFrame([(i, "a-b.md", f"passage {i}") for i in range(10)], "rowid long, source string, text string")
    items = ps.negatives(chunks, rules(("a b", {"questions": [{"question": "q1", "why_absent": "w"}, {"question": ""}, {"question": "q2"}]})), 2)
    assert [(r["question"], r["expected_empty"], r["notes"]) for r in items.collect()] == [("q1", True, "w"), ("q2", True, "")]
    numbered = ev.next_gold_ids(items, spark.createDataFrame([("G-007",), ("x",)], "id string"))
    assert [r["id"] for r in numbered.orderBy("id").collect()] == ["G-008", "G-009"]
    answer = {"results": [{"i": 0, "content": ["society", "nonsense", "economy"], "role": "primary"}, {"i": 1, "content": [], "role": "king"}]}
    got = {r["chunk_id"]: r for r in ps.content_labels(chunks, ("society", "economy"), ("primary",), rules(("passage 0", answer))).collect()}
    assert set(got) == {0, 1} and got[0]["content"] == ["society", "economy"] and got[1]["evidence_role"] is None


# ---- reports ------------------------------------------------------------------------------------


def test_blueprint(spark):
    chapters = spark.createDataFrame([(1, "Title", "why", "how", ["q?"], [], "h=1")], "chapter int, title string, purpose string, narrative string, questions array<string>, dependencies array<string>, stamp string")
    units = spark.createDataFrame([(1, 1, "1.1", "Unit", ["A"], [], ["g"])], "chapter int, unit int, id string, title string, primary array<string>, secondary array<string>, gaps array<string>")
    subs = spark.createDataFrame([(1, 1, 1, "1.1.1", "Sub", ["t"], ["q"], ["Akbar"]), (1, 1, 2, "1.1.2", "Bare", [], [], [])], "chapter int, unit int, pos int, id string, title string, topics array<string>, questions array<string>, unevidenced array<string>")
    refs = spark.createDataFrame([(1, 1, 1, 1, "S|x", "primary", None, "3–4", 2, 0.5, "c")], "chapter int, unit int, pos int, rank int, short string, kind string, locator string, pages string, passages int, score double, contribution string")
    md = rp.blueprints(chapters, units, subs, refs).first()["markdown"]
    for part in ("# Chapter 1 — Title", "<!-- stamp: h=1 -->", "| 1.1 | Unit | 2 | 1 | 1 | 0 | 1 |", "| S/x | primary | — | 3–4 | 2 | 0.500 | c |", "Not in the corpus:** Akbar", "Nothing cleared the relevance floor", "- none", "- g"):
        assert part in md, part


def test_coherence_report(spark):
    con = spark.createDataFrame([("E1", "rule", [("a", "in 1010", ["x"], [1]), ("b", "in 1020", ["x"], [3])])], "subject_entity string, relation string, sides array<struct<side:string,object:string,sources:array<string>,chapters:array<int>>>")
    ledger = spark.createDataFrame([(f"E{i}", 4, 3, 1, 2, True, True) for i in range(50)], "entity_id string, n_mentioned int, n_substantive int, first_mention int, first_substantive int, redundant boolean, forward boolean")
    xrefs = spark.createDataFrame([(1, 0, "see chapter 9", "explicit", 9, "no such chapter"), (2, 0, "chapter 1", "explicit", 1, None)], "chapter int, pos int, phrase string, direction string, target int, problem string")
    none = spark.createDataFrame([], "chapter int, rank int, score double, paragraph string")
    r = rp.coherence_report(con, ledger, xrefs, none).first()
    assert (r["n_contradictions"], r["n_redundant"], r["n_forward"], r["n_xrefs"], r["n_exemplars"]) == (1, 50, 50, 1, 0)
    assert "`in 1010`, chapters 1" in r["markdown"] and r["markdown"].count(" explained in 3 chapters") == rp.SHOWN and "## Candidates for style (0)\n\nNone." in r["markdown"]


def test_other_reports(spark):
    stages = spark.createDataFrame([("r", 3, "draft", 1, "warn", 2.5, {"b": "1", "a": "2"}), ("r", 3, "pack", 0, "ok", 1.0, {})], "run_id string, chapter int, name string, idx int, status string, seconds double, metrics map<string,string>")
    text = rp.run_summary(stages).first()["text"].split("\n")
    assert text[0] == "run r, chapter 3: warn" and text[1].startswith("pack") and text[2].endswith("2.5s a=2 b=1") and text[3] == "total 3.5s"
    pages = spark.createDataFrame([("a", 2, "two"), ("a", 1, "one")], "source string, page int, text string")
    errors = spark.createDataFrame([("a", 3, "bad|x"), ("b", 1, "lost")], "source string, page int, message string")
    got = {r["source"]: r["markdown"] for r in rp.page_results(pages, errors).collect()}
    assert got["a"].index("## Page 1") < got["a"].index("## Page 2") and "| 3 | bad/x |" in got["a"] and "| 1 | lost |" in got["b"]
    sections = spark.createDataFrame([("s", "body"), ("t", "fine")], "section string, text string")
    verdicts = spark.createDataFrame([("s", 1, "u", "unsupported", None, "date"), ("s", 2, "c", "Contradicted", "other", None), ("t", 1, "ok", "supported", None, None)], "section string, claim_id int, text string, verdict string, conflict string, missing string")
    ungrounded = spark.createDataFrame([("s", "Akbar", 1)], "section string, term string, rank int")
    prompts = {r["section"]: r["prompt"] for r in rp.repair_prompts(sections, verdicts, ungrounded).collect()}
    assert set(prompts) == {"s"} and prompts["s"].index("CONTRADICTED") < prompts["s"].index("UNSUPPORTED") and "Akbar" in prompts["s"] and prompts["s"].endswith("body")


def test_chapter_evaluation(spark, aliases):
    chapters = spark.createDataFrame([(1, "The king Bhoja of the long dynasty built a temple here [E1]. In 1055 the wise Udaya ruled over all of the land without [GAP: x] end")], "chapter int, text string")
    passages = spark.createDataFrame([(1, "Bhoja built it.")], "chapter int, text string")
    r = rp.chapter_evaluation(chapters, passages, aliases).first()
    assert (r["truncated"], r["gaps"], r["unresolved"], r["n_sentences"], r["n_cited"], r["uncited_factual"]) == (True, 1, 1, 2, 1, 1) and r["ungrounded_terms"] == 3


# ---- text, store, pages -------------------------------------------------------------------------


def test_scripts_meet(spark):
    pairs = [("भोज", "bhoja"), ("धार", "dhāra"), ("उदयादित्य", "udayāditya"), ("संस्कृत", "saṃskṛta"), ("क्षत्रिय", "kṣatriya"), ("औरंग", "auraṃga"), ("ज्ञान", "jñāna"), ("दुःख १२", "duḥkha 12"), ("Plain é", "Plain é")]
    df = spark.createDataFrame(pairs, "d string, l string")
    for r in df.select("l", tx.deva_to_latin(F.col("d")).alias("t"), tx.fold(F.col("d")).alias("a"), tx.fold(F.col("l")).alias("b")).collect():
        assert (r["t"], r["a"]) == (r["l"], r["b"])
    got = spark.createDataFrame([("Nīlakaṇṭhēśvara ﬁ Ǻ",), (None,)], "s string").select(tx.nfkd_strip(F.col("s"))).collect()
    assert [r[0] for r in got] == ["nilakanthesvara fi a", None]


def test_index_is_read_pruned(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"word{i % 50} common text {i}") for i in range(300)], "rowid long, text string")
    path = f"file://{tmp_path}/index"
    store.write_index(rows, {"raw": tx.tokens(F.col("text"))}, path, rows.select("rowid", F.array(F.lit(3.0), F.lit(4.0)).alias("embedding")))
    terms = spark.createDataFrame([(1, "raw", "word7")], "qid int, stream string, term string")
    lists, _ = store.read_index(spark, path, terms)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan.replace("#", "") or "bucket" in plan.split("PartitionFilters")[1][:80]
    assert "In(token" in plan or "EqualTo(token" in plan
    assert sorted(r["rowid"] for r in store.search(spark, path, terms, 100).collect()) == list(range(7, 300, 50))
    assert [round(x, 6) for x in spark.read.parquet(f"{path}/vectors").first()["embedding"]] == [0.6, 0.8]
    assert store.lookup_all(rows, []).count() == 0 and store.lookup_all(rows, [1, 2, 999]).count() == 2 and store.lookup(rows, 5).count() == 1


def test_stamps(spark, tmp_path):
    built = {"fingerprint": "f", "built_at": "t", "count": 3, "model": "m"}
    a, b = store.stamp(built, config.DEFAULTS), store.stamp(built, config.overlay(config.DEFAULTS, {"evaluation": {"beta": 2}}))
    assert a["hash"] == b["hash"] and a["full_config"] != b["full_config"]
    assert store.stamp(built, config.overlay(config.DEFAULTS, {"rerank": {"backend": "none"}}))["hash"] != a["hash"]
    store.save_stamp(spark, f"file://{tmp_path}/s", a)
    assert store.load_stamp(spark, f"file://{tmp_path}/s") == a


def test_labels_by_chunk(spark):
    rows = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "chunk_id long, structural string, labelled_at int")
    assert sorted((r["chunk_id"], r["structural"]) for r in store.labels_by_chunk(rows).collect()) == [(1, "new"), (2, "x")]


class Pages:
    def __init__(self, log):
        self.log = log

    def read_image(self, url):
        if "bad" in url or url.endswith("YmFk"):
            raise RuntimeError("401")
        return [url[:22], "two"]

    def upload(self, name, content):
        return name

    def read_document(self, handle):
        if handle.startswith("bad"):
            raise RuntimeError("broken")
        return ["p1", "p2"]

    def delete(self, handle):
        with open(self.log, "a") as f:
            f.write(handle + "\n")

    def read_layout(self, url):
        return "<|det|>text<|/det|>x"


def test_pages_are_read(spark, tmp_path):
    log = str(tmp_path / "deleted")
    files = spark.createDataFrame([("/x/a.JPG", bytearray(b"img")), ("/x/b.png", bytearray(b"bad"))], "path string, content binary")
    got = [(r["path"][-5:], r["page"], r["text"], r["status"]) for r in ocr.read_images(files, lambda: Pages(log)).orderBy("path", "page").collect()]
    assert got == [("a.JPG", 0, "data:image/jpeg;base64", "ok"), ("a.JPG", 1, "two", "ok"), ("b.png", None, None, "error:QuotaError")]
    docs = spark.createDataFrame([("/x/good.pdf", bytearray(b"1")), ("/x/bad.pdf", bytearray(b"2"))], "path string, content binary")
    assert ocr.read_documents(docs, lambda: Pages(log)).filter("status = 'ok'").count() == 2
    with open(log) as f:
        assert sorted(f.read().split()) == ["bad.pdf", "good.pdf"]
    render = lambda content, dpi, first, last: iter([(n, bytes([n])) for n in range(first, (last or 3) + 1)])
    images = ocr.page_images(docs.limit(1), first=2, render=render)
    assert [(r["page"], r["path"]) for r in images.orderBy("page").collect()] == [(2, "good_p0002.png"), (3, "good_p0003.png")]
    done = images.filter("page = 2").select("source", "page")
    assert [(r["source"], r["page"]) for r in ocr.read_layouts(images, lambda: Pages(log), done).collect()] == [("good.pdf", 3)]
