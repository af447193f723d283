from pyspark.sql import functions as F

from quarry.operators import drafting as dr
from quarry.sources import text_layer as tl


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_queries(spark):
    assert one(spark, dr.deterministic_queries(F.lit("Q?"), F.lit("Dhara"))) == ["Q?", "Q? — Dhara"]
    assert one(spark, dr.query_union(F.array(F.lit("A b"), F.lit("c")), F.array(F.lit("a B "), F.lit("d"), F.lit(" ")))) == ["A b", "c", "d"]
    subs = spark.createDataFrame([("k", "q"), ("m", "r")], "key string, question string")
    cache = subs.select("key", F.substring(F.sha1(F.lit("q").cast("binary")), 1, 16).alias("fingerprint"))
    assert [r["key"] for r in dr.stale_entries(subs, cache).collect()] == ["m"]


def test_embedding_texts(spark):
    n = F.lit(None).cast("string")
    assert one(spark, dr.embed_text(F.lit("s"), F.lit("A > B"), n, F.lit("body"))) == "[s] A > B\nbody"
    two = "\n".join(["latin words in a line of prose"] * 10 + ["देवनागरी पंक्ति यहाँ है"] * 5 + ["```"])
    assert "दे" not in one(spark, dr.embed_text(F.lit("s"), F.lit(""), F.lit("ctx"), F.lit(two)))
    p = F.lit(None).cast("int")
    assert one(spark, dr.context_sentence(F.lit("T"), F.lit("survey"), F.lit("A"), F.lit(3), F.lit(5))) == "From T, a survey. Section: A. Pages 3-5."
    assert one(spark, dr.context_sentence(F.lit("T"), n, n, p, p)) == "From T."


def test_plans(spark):
    plan = spark.createDataFrame([(2, [("U", ["a", "b"]), ("V", [])])], "chapter int, units array<struct<title:string,subs:array<string>>>")
    assert [r["id"] for r in dr.numbered(plan).orderBy("id").collect()] == ["2.1.1", "2.1.2", "2.2"]
    hits = spark.createDataFrame([("u", "s", "t", 1, 0.5, 3, 4, "made 1055"), ("u", "s", "t", 2, 0.7, 1, 2, "more"), ("v", "s", "t", 1, 0.1, None, None, "x")], "unit string, source string, trail string, rank int, score double, page_start int, page_end int, text string")
    refs = dr.merged_references(hits)
    r = refs.filter("unit = 'u'").first()
    assert (r["n"], r["score"], r["page_start"], r["page_end"], r["excerpt"]) == (2, 0.7, 1, 4, "made 1055 … more")
    units = spark.createDataFrame([("u",), ("w",)], "unit string")
    assert {x["unit"]: x["gap"] for x in dr.citation_plan(units, refs).collect()} == {"u": "thin", "w": "no reference"}
    o = dr.orphans(spark.createDataFrame([(1, ["a", "zz"])], "chapter int, keys array<string>"), spark.createDataFrame([(1, "a"), (1, "b")], "chapter int, key string")).first()
    assert o["planned"] == ["a"] and o["missing"] == ["b"]
    caps = dr.figure_captions(spark.createDataFrame([("u", 0, "Fig. 3 Plan; FIG. 3 plan. Plate IV Gate")], "unit string, pos int, text string")).orderBy("rank").collect()
    assert [c["caption"] for c in caps] == ["Fig. 3 Plan", "Plate IV Gate"]


def test_pages(spark):
    total, done = spark.createDataFrame([("s", 5)], "source string, total int"), spark.createDataFrame([("s", 2)], "source string, page int")
    assert [(r["page"], r["batch"]) for r in dr.missing_pages(total, done, 2).orderBy("page").collect()] == [(1, 0), (3, 0), (4, 1), (5, 1)]
    res = spark.createDataFrame([("s", 1, "a", "ok", 0), ("s", 1, "b", "ok", 1), ("s", 1, "c", "error", 2)], "source string, page int, text string, status string, batch_ord int")
    assert dr.collected_pages(res).first()["text"] == "b"
    assert one(spark, dr.book_page(F.lit("head\n 123 \n45"))) == 123 and one(spark, dr.book_page(F.lit("none"))) is None
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(["x", "ONE", "v1", "THREE", "v2", "TWO", "v3"])], "doc string, pos int, text string")
    heads = spark.createDataFrame([("d", 1, "ONE"), ("d", 2, "TWO"), ("d", 3, "THREE")], "doc string, chapter int, title string")
    assert [r["chapter"] for r in dr.chapter_of_lines(lines, heads).orderBy("pos").collect()] == [None, 1, 1, 1, 1, 2, 2]
    assert one(spark, dr.page_marks_whole(F.lit("<!-- page 1 --> <!-- page 3 -->"))) is False and one(spark, dr.page_marks_whole(F.lit("none"))) is True
    assert one(spark, dr.segments(F.lit("a" * 25), 10)) == ["a" * 10, "a" * 10, "a" * 5] and one(spark, dr.segments(F.lit(""))) == []
    assert one(spark, dr.output_path(F.lit("/in/a/b.pdf"), "/in/", "/out")) == "/out/a/b.md"


def test_text_layer(spark):
    long = "a long line of body text that wraps over here"
    page = lambda n: ("d", n, [([([("RUNNING", 9.0, False)],), ([(f"Title {n}", 16.0, True)],), ([(long, 10.0, False)],), ([("and goes on.", 10.0, False)],), ([(str(n + 1), 9.0, False)],)],)])
    pages = spark.createDataFrame([page(n) for n in range(5)] + [("d", 5, [])], "doc string, page int, blocks array<struct<lines:array<struct<spans:array<struct<text:string,size:double,bold:boolean>>>>>>")
    lines = tl.page_lines(pages)
    assert tl.body_size(lines).first()["body"] == 10.0 and [r["head"] for r in tl.running_heads(lines).collect()] == ["RUNNING"]
    assert tl.page_markdown(lines).filter("page = 2").first()["markdown"] == f"# Title 2\n\n{long} and goes on."
    assert tl.converted(lines, pages).first()["empty_pages"] == [5]
