"""Operators on small fixtures, with the rules that the driver's tables don't reach."""

import random

import pytest
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import numeric, text as tx
from quarry.operators import claims as cl, cleaning, coherence, entities as en, evaluation as ev, grounding as gr, labels as lb, models, retrieval as rt, runs, upserts
from quarry.sources import files, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_config():
    a = config.overlay(config.DEFAULTS, {"pack": {"keep": 5}})
    assert config.DEFAULTS["pack"]["keep"] == 10 and config.diff(a) == {"pack": {"keep": 5}}
    assert config.config_hash(a) != config.config_hash(config.DEFAULTS) and len(config.config_hash(a)) == 12
    assert config.section_hash(a, "index") == config.section_hash(config.DEFAULTS, "index")


@pytest.mark.parametrize("a, b", [("Rājeśvara", "Rajeshwar"), ("Viśvakarma", "Vishwakarma's"), ("Bhoja", "boja")])
def test_fold(spark, a, b):
    x, y = one(spark, tx.fold(F.lit(a))), one(spark, tx.fold(F.lit(b)))
    assert x.rstrip("a") == y.rstrip("a") and x


def test_text_functions(spark):
    t = F.lit("The king Bhoja built. Then Dhara grew; see Malwa and king bhoja, Malwa in 1055-60 or 12345.")
    assert one(spark, tx.proper_nouns(t)) == ["Bhoja", "Dhara", "Malwa"]
    assert one(spark, tx.numerals(t)) == ["1055-60"]
    assert one(spark, tx.numbers(F.lit("1,200 and -3.5 and 1200"))) == ["1200", "-3.5"]
    assert one(spark, tx.predicate_key(F.lit("was built by the"))) == ["built", "by", "the"]
    assert one(spark, tx.predicate_key(F.lit("built by the"))) == ["built", "by", "the"]
    assert one(spark, tx.dehyphenate(F.lit("tem-\n ple"))) == "temple"
    assert one(spark, tx.surname(F.lit("Mason, Stella and X"))) == one(spark, tx.fold(F.lit("Mason")))
    assert one(spark, tx.anchor(F.lit(" The Plan: one!"))) == "the-plan-one"
    assert one(spark, tx.endnote(F.lit("K"), F.lit("A > B"), F.lit(3), F.lit(4))) == "K, 'B', pp. 3-4"
    assert one(spark, tx.claim_id(F.lit("a"), F.lit(None).cast("string"))) != one(spark, tx.claim_id(F.lit("a")))
    assert one(spark, tx.word_shingles(F.lit("one two three"))) == []


def test_numeric(spark):
    e = F.array().cast("array<int>")
    assert one(spark, numeric.jaccard(e, e)) == 0.0
    assert one(spark, numeric.f_beta(F.lit(0.0), F.lit(0.0))) == 0.0
    assert one(spark, numeric.normalised(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]
    assert one(spark, numeric.sigmoid(F.lit(-1000.0))) == pytest.approx(9.36e-14, rel=1e-2)


TEXT = """<!-- page 1 -->
# ALPHA BOOK
First line of prose.

<!-- a comment
over lines -->

ALPHA BOOK
12
More prose here.
<!-- page 2 -->
ALPHA BOOK
## Part One
Body $^{17}$ text ![x](y.png).
---
ALPHA BOOK
### Deep
deep text
ALPHA BOOK
# Next
last
"""


def test_clean_lines(spark):
    docs = spark.createDataFrame([(1, TEXT), (2, None), (3, "")], "doc_id long, text string")
    rows = cleaning.clean_lines(docs).orderBy("doc", "pos").collect()
    texts = [r["text"] for r in rows if r["doc"] == 1]
    assert texts.count("ALPHA BOOK") == 1 and "12" not in texts and texts[-1] == "last"
    assert not any(a == "" and b == "" for a, b in zip(texts, texts[1:], strict=False))
    assert {r["text"]: r["page"] for r in rows}["deep text"] == 2
    assert "Body  text ." in texts
    trail = {r["text"]: r["trail"] for r in cleaning.heading_trails(cleaning.clean_lines(docs)).collect()}
    assert trail["deep text"] == "ALPHA BOOK > Part One > Deep" and trail["last"] == "Next"
    assert cleaning.clean_markdown(cleaning.clean_lines(docs)).filter("doc = 1").first()["text"].startswith("# ALPHA BOOK\n")


def test_chunk_bounds():
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        kind = rnd.random()
        rows.append((f"H{i}", 1, 1, f"H{i}") if kind < 0.03 else ("", i // 20, 0, "") if kind < 0.2 else (" ".join("w" * rnd.randint(1, 12) + rnd.choice([".", "", ""]) for _ in range(rnd.randint(1, 400 if kind > 0.97 else 40))), i // 20, 0, ""))
    chunks = cleaning.pack_lines(rows)
    assert chunks and all(len(c["text"]) <= cleaning.MAX_CHARS for c in chunks)
    assert [c["chunk"] for c in chunks] == list(range(len(chunks)))
    assert all(len(x) <= 50 for x in cleaning.split_long("a" * 120 + " b. c d " * 30, 50))


def test_page_ranges(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 3, 7, 8, 10, 2)], "g string, page int")
    assert cleaning.page_ranges(df, "g").first()["ranges"] == "1-3, 7-8, 10"


def test_filters_admit_what_is_unknown(spark):
    chunks = spark.createDataFrame([(i, f"s{i}") for i in range(6)], "rowid long, source string")
    sources = spark.createDataFrame([("s0", "book", None, None), ("s1", "book", 900, 1000), ("s2", "book", 1300, 1400)], "source string, kind string, period_from int, period_to int")
    labels = spark.createDataFrame([(0, "text", ["inscription_meta"], None, True), (1, "text", ["inscription"], 0.9, None), (2, "text", ["inscription"], 0.1, False)], "chunk_id long, structural string, content array<string>, quality double, retrievable boolean")
    ids = lambda **f: sorted(r[0] for r in rt.allowed_rows(chunks, sources, labels, **f).collect())
    assert ids() == [0, 1, 3, 4, 5]
    assert ids(include_junk=True) == [0, 1, 2, 3, 4, 5]
    assert ids(content=["inscription"]) == [1]
    assert ids(min_quality=0.5) == [0, 1, 3, 4, 5]
    assert ids(period=(950, 1100)) == [0, 1, 3, 4, 5]
    assert ids(period=(1100, 1200), include_junk=True) == [0, 3, 4, 5]
    assert ids(source=["s1"], kind=["book"]) == [1]


def test_bm25_without_terms_has_no_rows(spark):
    rows = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, "beta")], "rowid long, text string")
    s = {"raw": tx.tokens(F.col("text")), "folded": tx.folded_tokens(F.col("text"))}
    q = spark.createDataFrame([(1, "a ?"), (2, "alpha beta")], "qid long, query string")
    got = rt.bm25(rt.postings(rows, s), rt.doc_lengths(rows, s), rt.query_terms(q)).collect()
    assert {r["qid"] for r in got} == {2} and {r["rowid"] for r in got} == {1, 3}


def greedy(rows, keep, cap):
    out, held, n = [], [], {}
    for r in sorted(rows, key=lambda r: (-r[2], r[0])):
        if n.get(r[1], 0) < cap and len(out) < keep:
            out.append(r)
            n[r[1]] = n.get(r[1], 0) + 1
        else:
            held.append(r)
    out += held[: keep - len(out)]
    return sorted(out, key=lambda r: (-r[2], r[0]))


def test_diversity_is_greedy(spark):
    rnd = random.Random(3)
    rows = [(q, i, rnd.choice("abc"), rnd.randint(0, 20) / 10) for q in range(30) for i in range(rnd.randint(0, 25))]
    df = spark.createDataFrame(rows, "sub int, rowid int, source_group string, score double")
    got = {}
    for r in rt.diversity_cap(df, 10).orderBy("sub", "pos").collect():
        got.setdefault(r["sub"], []).append((r["rowid"], r["source_group"], r["score"]))
    for q in {r[0] for r in rows}:
        assert got[q] == greedy([r[1:] for r in rows if r[0] == q], 10, 5)


def test_rrf_does_not_depend_on_channel_order(spark):
    rnd = random.Random(4)
    rows = [(1, c, 0, i, r + 1) for c in ("x", "y", "z") for r, i in enumerate(rnd.sample(range(40), 30))]
    a = rt.rrf(rt.flatten_channel(spark.createDataFrame(rows, "sub int, channel string, query_ord int, rowid int, rank int")), {"x": 1, "y": 2, "z": 0})
    b = rt.rrf(rt.flatten_channel(spark.createDataFrame(rows[::-1], "sub int, channel string, query_ord int, rowid int, rank int")), {"x": 1, "y": 2, "z": 0})
    key = lambda df: [(r["rowid"], r["rrf"], r["rank"]) for r in df.orderBy("rank").collect()]
    assert key(a) == key(b) and all("z" not in r["channels"] for r in a.collect())


def test_lost_in_middle_and_status(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(2, i) for i in range(3)], "sub int, pos int")
    got = {(r["sub"], r["pos"]): r["shown"] for r in rt.lost_in_middle(df).collect()}
    assert [got[1, i] for i in range(5)] == [0, 4, 1, 3, 2] and [got[2, i] for i in range(3)] == [0, 1, 2]
    kept = spark.createDataFrame([(1, "a", 0.9)] * 3 + [(2, "a", 0.9)] + [(3, "a", 0.1), (3, "b", 0.1), (3, "b", 0.1)] + [(4, "a", 0.9), (4, "b", 0.8), (4, "a", 0.7)], "sub int, source string, score double")
    s = {r["sub"]: r["status"] for r in rt.pack_status(spark.range(1, 6).select(F.col("id").cast("int").alias("sub")), kept, True).collect()}
    assert s == {1: "SINGLE-SOURCE", 2: "THIN", 3: "THIN", 4: "OK", 5: "GAP"}
    un = spark.createDataFrame([(4, ["X"]), (1, ["X"])], "sub int, absent array<string>")
    assert {r["sub"]: r["status"] for r in rt.partial_status(rt.pack_status(kept.select("sub").distinct(), kept, True), un).collect()}[4] == "PARTIAL"


def registry(spark):
    rows = [("E:P:001", "Bhoja", "person", ["Bhojadeva", "King Bhoja"], True), ("E:P:002", "Bhoj", "person", [], False), ("E:P:003", "King Bhoja of Dhara", "person", [], False), ("E:T:001", "Dhara", "place", ["Bhoja"], False)]
    return en.normalised_registry(spark.createDataFrame(rows, "entity_id string, canonical string, type string, aliases array<string>, curated boolean"))


def test_entities(spark):
    reg = registry(spark)
    al = en.aliases(reg)
    got = {r["term"]: r["entity_id"] for r in en.resolve(spark.createDataFrame([("Bhoja",), ("bhoja's",), ("Dharā",), ("Nobody",)], "term string"), al).collect()}
    assert got == {"Bhoja": "E:P:001", "bhoja's": "E:P:001", "Dharā": "E:T:001", "Nobody": None}
    assert [r["ids"] for r in en.collisions(al).filter("folded = 'boja'").collect()] == [["E:P:001", "E:T:001"]]
    rows = spark.createDataFrame([(1, "King Bhoja and Bhoja at Dhara"), (2, None), (3, "nothing")], "rowid long, text string")
    m = {(r["entity_id"], r["chunk_id"]): r["n"] for r in en.mentions(rows, al).collect()}
    assert m[("E:P:001", 1)] == 3 and m[("E:T:001", 1)] == 3 and not any(k[1] != 1 for k in m)
    assert {(r["a"], r["b"]) for r in en.near_duplicates(reg).collect()} >= {("E:P:001", "E:P:002")}
    host = {r["entity_id"]: r["host"] for r in en.merge_prefixes(spark.createDataFrame([("a", "Old", "x", True), ("b", "Old Town", "x", False), ("c", "Old Town Hall", "x", False), ("d", "Oldest", "x", False), ("e", "Old Man", "y", False)], "entity_id string, canonical string, type string, curated boolean")).collect()}
    assert host == {"b": "a", "c": "a"}
    ids = [r["entity_id"] for r in en.next_ids(spark.createDataFrame([("p", "x"), ("p", "y")], "type string, canonical string"), spark.createDataFrame([("p", "E:P:009")], "type string, entity_id string")).orderBy("canonical").collect()]
    assert ids == ["E:P:010", "E:P:011"]


def test_unattested(spark):
    terms = spark.createDataFrame([(1, "Bhojadeva"), (1, "Ujjain"), (1, "Rajeshwar"), (2, "Bhoja")], "sub int, term string")
    passages = spark.createDataFrame([(1, "King Bhoja saw Rajesvara.")], "sub int, text string")
    got = {(r["sub"], r["term"]) for r in en.unattested(terms, passages, en.aliases(registry(spark))).collect()}
    assert got == {(1, "Ujjain"), (2, "Bhoja")}


LONG = "This sentence has certainly got many more than eighteen words in it so that it counts as running prose here. "


@pytest.mark.parametrize(
    "text, label",
    [
        ("", "image"), (None, "image"), ("Contents\nOne .... 3\nTwo .... 9", "toc"), ("| a | b |\n| 1 | 2 |", "table"), ("- one\n- two\n- three", "list"), ("Figure 3: A plan", "caption"),
        ("Temple, 12\nShrine, 14, 15\nGate, 2", "index"), ("Bibliography\nSome work", "bibliography"), ("$x = y$", "formula"), (LONG * 3, "text"), (LONG * 2 + "\nTemple, 12\nShrine, 14\nGate, 2", "text"),
        ("<|det|>title [1,2,3,4]<|/det|>Short<|det|>table [1,2,3,4]<|/det|>A much longer body", "table"), ("<!-- element:caption -->\nx", "caption"),
    ],
)
def test_structural_labels(spark, text, label):
    assert one(spark, lb.structural_label(F.lit(text).cast("string"), F.lit(""))) == label


def test_quality(spark):
    rows = spark.createDataFrame([(1, LONG * 4, "text"), (2, "", "image"), (3, "short text that ends", "text"), (4, "| 1 | 2 |\n| 3 | 4 |", "table"), (5, None, "image")], "rowid long, text string, structural string")
    q = {r["rowid"]: (r["quality"], r["issues"]) for r in lb.quality(rows).collect()}
    assert q[1] == (1.0, []) and q[4] == (1.0, []) and q[2][0] == 0.0
    assert q[3][1] == ["ocr-damage:0.9", "short:4w", "fragment"] or q[3][1] == ["ocr-noise:0.9", "short:4w", "fragment"]
    assert any(i.startswith("non-evidential") for i in q[5][1])


def test_near_duplicates(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    w = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:-2])), (3, " ".join(w + ["tail"] * 3)), (4, "too short"), (5, None), (6, " ".join(reversed(w)))]
    docs = spark.createDataFrame(rows, "rowid long, text string")
    pairs = lb.near_duplicate_pairs(docs)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(1, 2), (1, 3), (2, 3)}
    groups = lb.star_groups(pairs)
    assert {r["rowid"]: r["head"] for r in groups.collect()} == {1: 1, 2: 1, 3: 1}
    assert {r["rowid"]: r["keep"] for r in lb.duplicates_of(groups, docs).collect()} == {1: 3, 2: 3}
    # 1-2, 2-3 similar, 1-3 not: 2 joins 1 and 3 stands alone.
    star = lb.star_groups(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    assert {r["rowid"]: r["head"] for r in star.collect()} == {1: 1, 2: 1, 3: 3}


def pack_rows(spark, rows):
    return spark.createDataFrame(rows, "n int, sub string, id string, source string, text string, page_start int")


GOOD = [(1, s, f"E{i}", f"b{i % 5}", f"text {i}", i) for i, s in enumerate("aaabbb", 1)]


def report(spark, rows, **kw):
    subs = spark.createDataFrame([(1, "a"), (1, "b")], "n int, sub string")
    known = spark.createDataFrame([(f"b{i}",) for i in range(5)], "source string")
    checked = gr.validate_passages(pack_rows(spark, rows), known, **kw)
    return gr.pack_report(subs, checked).first(), {r["id"]: r for r in checked.collect()}


def test_pack_validation(spark):
    assert report(spark, GOOD)[0]["status"] == "ok"
    assert report(spark, [(*GOOD[0][:4], "", 1), *GOOD[1:]])[0]["status"] == "fail"
    assert report(spark, [(*GOOD[0][:3], None, "t", 1), *GOOD[1:]])[0]["status"] == "fail"
    assert report(spark, [(*GOOD[0][:3], "zz", "t", 1), *GOOD[1:]])[0]["status"] == "warn"
    r, by_id = report(spark, [*GOOD[:5], (1, "b", "E6", "b1", " TEXT  1", 1)])
    assert by_id["E6"]["duplicate_of"] == "E1" and r["usable"] == 5
    assert report(spark, [*GOOD[:5], (1, "b", "E5", "b1", "other", 1)])[0]["n_errors"] == 2
    assert report(spark, GOOD[:3])[0]["gaps"] == 1 and report(spark, GOOD[:4])[0]["thin"] == 1
    assert report(spark, [])[0]["status"] == "fail"
    no_page = [(*GOOD[0][:5], None), *GOOD[1:]]
    assert report(spark, no_page)[0]["status"] == "warn" and report(spark, no_page, require_pages=True)[0]["status"] == "fail"


def test_citations(spark):
    p = spark.createDataFrame([(1, f"E{i}") for i in range(1, 20)], "n int, id string")
    b = spark.createDataFrame([(1, "A [E4]. B [E1] and [E4] [E999] . C [E12].")], "n int, body string")
    r = gr.resolve_citations(b, p).first()
    assert r["cited"] == ["E4", "E1", "E12"] and r["bogus"] == ["E999"] and r["resolved"] == "A [1]. B [2] and [1]. C [3]."
    before = spark.createDataFrame([(1, "A [E1]. B [E1]. [GAP: x]")], "n int, body string")
    after = spark.createDataFrame([(1, "A [E1]. B. [E2]")], "n int, body string")
    assert {(x["id"], x["dropped"], x["added"]) for x in gr.citation_delta(before, after).collect()} == {("E1", 1, 0), ("GAP", 1, 0), ("E2", 0, 1)}


def test_verdicts(spark):
    rows = [(1, "supported")] + [(1, "unverified")] * 3 + [(2, None)] * 4 + [(2, "odd")] + [(3, "supported")] * 3 + [(3, "unsupported")] + [(3, "unverified")] * 2
    r = {x["section"]: x for x in gr.verdict_rates(spark.createDataFrame(rows, "section int, verdict string")).collect()}
    assert (r[1]["checked"], r[1]["rate"], r[1]["coverage"]) == (1, 1.0, 0.25)
    assert (r[2]["rate"], r[2]["coverage"], r[2]["unverified"]) == (1.0, 0.0, 5)
    assert r[3]["rate"] == 0.75 and r[3]["coverage"] == pytest.approx(4 / 6)


def test_cut_quotes(spark):
    text = "# one two three four five six\none two three four five six. Rest."
    q = F.array(F.lit("one two three four five six"), F.lit("Rest"))
    assert one(spark, gr.cut_quotes(F.lit(text), q)) == text  # the first place is in a heading
    assert one(spark, gr.cut_quotes(F.lit("x one two three four five six. Rest."), q, "[GAP]")) == "x [GAP]. Rest."
    assert one(spark, gr.edit_accepted(F.lit("a b c d"), F.lit("a b c d e"))) is False


def claim(s, p, o, src, scope="corpus", ch=None):
    return (scope, s, p, o, src, ch)


def test_conflicts(spark):
    rows = [claim("t", "was built by", "X", "a"), claim("t", "built by", "Y", "b"), claim("u", "has height", "10 m", "a"), claim("u", "height", "12 m", "b"), claim("v", "is", "p", "a"), claim("w", "stands in", "A", "a"), claim("w", "stands in", "B", "a"), claim("m", "dates", "900", "c1", "manuscript", 1), claim("m", "dates", "950", "c2", "manuscript", 2)]
    df = spark.createDataFrame(rows, "scope string, subject_entity string, predicate string, object string, source string, chapter int")
    assert {r["subject_entity"]: r["kind"] for r in cl.conflicts(df).collect()} == {"t": "verbal", "u": "numeric"}
    assert [r["subject_entity"] for r in cl.ordered_conflicts(cl.conflicts(df)).collect()] == ["u", "t"]
    assert [r["subject_entity"] for r in cl.manuscript_contradictions(df).collect()] == ["m"]


def test_works(spark):
    ids = spark.createDataFrame([("k.md", "Mason, Stella", "The Hindu Temple in full", 1946, "htf"), ("b.md", "Brown, Percy", "Buddhist architecture", 1942, "ba")], "source string, author string, title string, year int, alias string")
    works = spark.createDataFrame([("W1", "Mason, S", None, 1946), ("W2", "Nobody", "A study of architecture", 1900), ("W3", None, "Buddhist architecture", None)], "work_id string, author string, title string, year int")
    assert {r["work_id"]: (r["source"], r["score"]) for r in cl.match_works(works, cl.corpus_identities(ids)).collect()} == {"W1": ("k.md", 3), "W3": ("b.md", 3)}
    text = "Brown, Percy, Indian Architecture,\nBombay, 1942.\n— Buddhist Times, Press, 1950.\nMason (1946) says; see (Brown, 1942: 3) ibid."
    rows = spark.createDataFrame([(1, "s", text)], "rowid long, source string, text string")
    e = cl.bibliography_entries(rows).orderBy("pos").collect()
    assert e[0]["raw"] == "Brown, Percy, Indian Architecture, Bombay, 1942." and e[1]["author"] == e[0]["author"]
    kinds = {(r["kind"], r["author"], r["year"]) for r in cl.citation_surfaces(rows).collect()}
    assert {("narrative_year", "Mason", 1946), ("author_year", "Brown", 1942)} <= kinds and any(k[0] == "ibid" for k in kinds)


def test_coherence(spark):
    m = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True), ("a", 4, True), ("b", 1, True), ("c", 2, False)], "entity_id string, chapter int, substantive boolean")
    r = {x["entity_id"]: (x["redundant"], x["forward"]) for x in coherence.concept_ledger(m).collect()}
    assert r == {"a": (True, True), "b": (False, False), "c": (False, False)}
    ch = spark.createDataFrame([(1, "as we saw in chapter 9. We will see later."), (2, "see the next chapter. In chapter 1 it is.")], "chapter int, text string")
    x = {(r["chapter"], r["direction"], r["target"], r["problem"]) for r in coherence.cross_references(ch).collect()}
    assert (1, "backward", 9, "no such chapter") in x and (2, "forward", None, "forward from the last chapter") in x and (2, "explicit", 1, None) in x


def test_evaluation(spark):
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "qid int, rowid int, rank int")
    gold = spark.createDataFrame([(1, 11), (1, 12), (2, 5)], "qid int, rowid int")
    r = {x["qid"]: x for x in ev.ranking_metrics(ranked, gold).collect()}
    assert r[1]["mrr"] == 0.5 and r[1]["recall_10"] == 1.0 and r[1]["ndcg"] == pytest.approx((0.63093 + 0.5) / 1.63093, rel=1e-4)
    assert r[2]["mrr"] == 0.0 and r[2]["n_results"] == 0
    q = spark.createDataFrame([(1, True), (3, True)], "qid int, expected_empty boolean")
    assert tuple(ev.empty_accuracy(q, ranked).first()) == (2, 1, 1)
    v = spark.createDataFrame([(float(i % 2),) for i in range(200)], "value double")
    b = ev.bootstrap_ci(v, samples=300).first()
    assert b["lo"] < 0.5 < b["hi"] and b["hi"] - b["lo"] < 0.25
    assert tuple(b) == tuple(ev.bootstrap_ci(v, samples=300).first())


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1, True), (2, "b", 2, False), (3, "c", 3, None)], "k int, x string, y int, reviewed boolean")
    new = spark.createDataFrame([(1, "A"), (2, "B"), (4, "D")], "k int, x string")
    got = {r["k"]: (r["x"], r["y"]) for r in upserts.protected_upsert(old, new, ["k"], F.coalesce("reviewed", F.lit(False))).collect()}
    assert got == {1: ("a", 1), 2: ("B", 2), 3: ("c", 3), 4: ("D", None)}
    assert upserts.insert_or_ignore(old.select("k", "x"), new, ["k"]).count() == 4
    r = upserts.conditional_merge(old.select("k", "x", F.coalesce("reviewed", F.lit(False)).alias("curated")), new.withColumn("curated", F.lit(False)), "k")
    assert {x["k"]: x["x"] for x in r.collect()} == {1: "a", 2: "B", 3: "c", 4: "D"}
    f = lambda df: upserts.fingerprint(df, "k", "x").first()[0]
    assert f(old) == f(old.orderBy(F.desc("k")).repartition(3)) != f(new)


def test_models(spark):
    assert models.parse_json('```json\n{"a": "}"}\n```') == {"a": "}"} and models.parse_json('Well: [1, {"b": 2}] ok') == [1, {"b": 2}]
    with pytest.raises(models.TruncatedError):
        models.parse_json('{"a": [1, 2')
    assert models.classify_error("429 Too Many Requests") == (True, True, False) and models.classify_error("quota exceeded")[2] and models.classify_error("bad key") == (False, False, False)
    lim = models.RateLimiter(1.0, clock=lambda: 0.0, sleep=lambda s: None)
    lim.throttled()
    assert lim.rate == 0.5
    assert one(spark, models.retry_after(F.lit("Retry-After: 900"))) == 300.0
    rows = spark.createDataFrame([(1, "p"), (2, None)], "i int, prompt string")
    got = models.complete(rows, models.StubClient, as_json=True).orderBy("i").collect()
    assert [r["reply_status"] for r in got] == ["ok", "ok"] and got[0]["reply"] == '{"echo": "p"}'
    bad = models.complete(rows, lambda: models.StubClient(reply="{broken"), as_json=True).collect()
    assert {r["reply_status"] for r in bad} == {"truncated"} and all(r["reply"] is None for r in bad)
    assert len(models.embed(spark.createDataFrame([("t",)], "text string"), models.StubClient).first()["embedding"]) == 16
    pairs = spark.createDataFrame([(1, "a b", "a b c"), (1, "a b", None)], "sub int, query string, text string")
    assert sorted(r["score"] for r in models.score_pairs(pairs, models.StubClient).collect()) == [0.0, 1.0]
    assert models.pick_backend(["hosted"], {"hosted": "no key"}) == ("none", "hosted: no key")


def test_runs(spark):
    r = runs.Run(3)
    with r.stage("load") as s:
        s.sources.append({"source": "k.md", "passages": 12})
        s.sources.append({"source": "b.md", "passages": 3})
    with pytest.raises(ValueError), r.stage("draft") as s:
        s.sources.append({"source": "k.md", "cited": 4})
        raise ValueError("x")
    assert r.status == "fail" and r.stages[1].errors == ["ValueError: x"]
    assert [tuple(x)[1:] for x in runs.merged_sources(r.rows(spark)).collect()] == [("k.md", 12, 4), ("b.md", 3, None)]


def test_files(spark, tmp_path):
    d = tmp_path / "corpus"
    d.mkdir()
    (d / "a.md").write_text("# A\ntext")
    (d / "b.txt").write_text("no")
    (d / "chapter-07.md").write_text("seven")
    assert {r["source"] for r in files.markdown_corpus(spark, str(d)).collect()} == {"a.md", "chapter-07.md"}
    assert [tuple(r) for r in files.chapters(spark, str(d)).collect()] == [(7, "seven")]
    assert files.discover(spark, str(d), exclude=r"\.txt$").count() == 2
    (tmp_path / "c.jsonl").write_text('{"source": "a", "chunk": 1, "text": "y"}\n{"source": "a", "chunk": 0, "text": "x"}\n')
    assert [(r["rowid"], r["text"]) for r in files.chunk_file(spark, str(tmp_path / "c.jsonl")).orderBy("rowid").collect()] == [(0, "x"), (1, "y")]
    raw = "<|det|>title [1, 2, 3, 4]<|/det|>Head<|det|>text<|/det|>Body<|det|>footer [0,0,1,1]<|/det|>9"
    assert one(spark, files.elements_markdown(files.det_spans(F.lit(raw)))) == "## Head\n\nBody"
    parts = files.page_parts(spark.createDataFrame([("p", 10 << 20, 25)], "path string, length long, pages int"), chunk_mb=4)
    assert [tuple(r)[1:] for r in parts.orderBy("lo").collect()] == [(0, 10), (10, 20), (20, 25)]
    pages = files.page_text(spark.createDataFrame([("s", 0, "x"), ("s", 2, " ")], "source string, page int, text string"), spark.createDataFrame([("s", 3)], "source string, total int")).first()["text"]
    assert "[NOT PROCESSED]" in pages and "No machine-readable" in pages and one(spark, files.split_pages(F.lit(pages)))[0]["text"] == "x"


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.swap_table(spark.range(3).toDF("a"), path, spark)
    sinks.swap_table(sinks.current_table(path, spark).filter("a > 0"), path, spark)
    assert sinks.current_table(path, spark).count() == 2
    out = sinks.assembled(spark.createDataFrame([(1, "One"), (2, "Two")], "chapter int, title string"), spark.createDataFrame([(2, "text here")], "chapter int, text string")).first()
    assert out["words"] == 2 and out["missing"] == 1 and out["markdown"].startswith("# One")


def test_streaming(spark, sf, tmp_path):
    from quarry.streaming import ingest

    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    src = tmp_path / "in"
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(str(src))
    events = ingest.read_new(spark, str(src), schema, 1)
    q = ingest.append(ingest.distinct_events(events, "36500 days").select("event_id", "event_type"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(str(src)).select("event_id").distinct().count()
    batch = ingest.event_windows(spark.read.parquet(str(src)))
    assert batch.agg(F.sum("n")).first()[0] == spark.read.parquet(str(src)).count()


def test_proper_nouns_after_many_blanks_and_in_long_texts(spark):
    import time

    name = lambda k: "X" + "".join(chr(97 + k // 26**i % 26) for i in range(4))
    many = " ".join(f"of {name(k)} {name(k).upper()}" for k in range(40_000))
    rows = [(1, "king" + " " * 30 + "Bhoja\n\n\n" + "\t" * 12 + "Dhara. " + " " * 20 + "Then BHOJA"), (2, many)]
    t = time.time()
    got = {r["i"]: r["n"] for r in spark.createDataFrame(rows, "i int, text string").select("i", tx.proper_nouns(F.col("text")).alias("n")).collect()}
    assert got == {1: ["Bhoja", "Dhara"], 2: [name(k) for k in range(40_000)]} and time.time() - t < 60


def test_near_duplicate_names_in_groups(spark, monkeypatch):
    """Many entities of one name, ids with several rows, equal and missing orders: as comparing each with each gives."""
    monkeypatch.setattr(en, "GROUP", 3)
    monkeypatch.setattr(en, "DEALT", 10)
    names = ["re", "red", "redo", "redorange", "blu", "redorangebluegreen", "", None]
    rows = [(f"E{i}", names[i % 8], i) for i in range(64)] + [("E1", "redorb", 1), ("E1", "redorb", 1), ("E2", "redorbi", 70), ("E80", "bl", None), ("E81", "bl", 3), (None, "b", 90)]
    reg = spark.createDataFrame(rows, "entity_id string, canonical string, ord int")
    got = [(r["a"], r["b"]) for r in en.near_duplicates(reg).collect()]
    want = set()
    for x, n, o in rows:
        for y, m, p in rows:
            if n and m and o is not None and p is not None and o != p and m != n and m.startswith(n) and len(m) - len(n) <= 12:
                want.add((x, y) if o < p else (y, x))
    assert len(got) == len(set(got)) and set(got) == want


def test_near_duplicate_names_move_once_for_each_part(spark):
    """A name that begins thousands of others: what is written and shuffled follows the entities, not the pairs."""

    def moved():
        g = spark.sparkContext._gateway
        stages = g.jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, g.new_array(g.jvm.double, 0), None))
        return sum(s.shuffleWriteBytes() + s.outputBytes() for s in stages)

    letters = "bcdfgklmnprstvz"
    rows = [(f"S{i}", "Red", i) for i in range(3000)] + [(f"L{i}", "Red" + "".join("aeiu"[j % 4] + letters[i // 15**j % 15] for j in range(3)), 3000 + i) for i in range(3000)]
    reg = spark.createDataFrame(rows, "entity_id string, canonical string, ord int")
    before = moved()
    got = en.near_duplicates(reg).agg(F.count("*").alias("n"), F.count_if(F.col("a").startswith("S") & F.col("b").startswith("L")).alias("ordered"), F.approx_count_distinct(F.xxhash64("a", "b"), 0.02).alias("different")).first()
    assert got["n"] == got["ordered"] == 9_000_000 and got["different"] > 8_000_000
    assert moved() - before < 5_000_000
