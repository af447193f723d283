"""Every query against its SQL, and those without SQL against plain Python."""

import collections
import re

import pytest
import regex
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import claims as cl, cleaning, entities as en
from quarry.plans import operators as _operators, queries  # noqa: F401
from quarry.plans.queries import _registry
from quarry.plans.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(same, name):
    same(QUERIES[name], SQL[name])


def rows_of(spark, sf, name):
    return QUERIES[name](spark, sf).collect()


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


WORD = regex.compile(tx.WORD)
NO_SQL = {
    "bootstrap_ci", "exclusion_reasons", "dup_demotion", "clean_page_lines", "heading_trail", "chunker", "proper_noun_freq", "candidate_terms", "ungrounded_terms", "work_match", "cross_refs",
}


def test_all_queries_are_compared():
    assert set(QUERIES) - set(SQL) == NO_SQL


def nouns(text):
    """Capitalised words that don't start a sentence, first spellings."""
    out = {}
    for m in WORD.finditer(text or ""):
        w, before = m[0], (text or "")[: m.start()].rstrip()
        if len(w) >= 3 and w[0].isupper() and w.lower() not in tx.STOP_TERMS and before and before[-1] not in tx.SENTENCE_START:
            out.setdefault(w.lower(), w)
    return list(out.values())


def test_proper_nouns(spark, sf):
    want = collections.Counter(w for r in read(spark, sf, "documents") for w in nouns(r["text"]))
    assert {r["term"]: r["n"] for r in rows_of(spark, sf, "proper_noun_freq")} == want and want


def test_candidate_terms(spark, sf):
    n = collections.Counter(w for r in read(spark, sf, "documents") for w in set(nouns(r["text"])))
    known = {r["folded"] for r in en.aliases(_registry(spark)).collect()}
    known |= {re.sub("a$", "", k) for k in known}
    df = spark.createDataFrame([(w,) for w in n], "w string").select("w", tx.fold(F.col("w")).alias("f"))
    left = sorted((-n[r["w"]], r["w"]) for r in df.collect() if r["f"] not in known)
    every = en.candidate_terms(queries.documents(spark, sf), en.aliases(_registry(spark)), 1, 10_000).collect()
    assert [(r["term"], r["n"]) for r in every] == [(w, -k) for k, w in left] and left
    assert [(r["term"], r["n"]) for r in rows_of(spark, sf, "candidate_terms")] == [(w, -k) for k, w in left if k <= -3][:200]


def test_ungrounded_terms(spark, sf):
    turns = read(spark, sf, "conversations")
    said = lambda r: (r["text"] or "") + (" It was in Zanzibar, in 1947." if r["turn"] % 3 == 1 else "")
    asked = {str(r["conv_id"]): " ".join(said(x) for x in turns if x["conv_id"] == r["conv_id"] and x["role"] == "user") for r in turns}
    want = {(c, x) for r in turns if r["role"] == "assistant" for c in [str(r["conv_id"])] for x in ("Zanzibar", "1947") if x in said(r) and x not in asked[c]}
    got = {(r["sub"], r["term"]) for r in rows_of(spark, sf, "ungrounded_terms")}
    assert want and want <= got
    assert all(term in " ".join(said(x) for x in turns if str(x["conv_id"]) == c and x["role"] == "assistant") for c, term in got)


def test_bootstrap(spark, sf):
    v = [float(r["quality"]) for r in read(spark, sf, "labels") if r["quality"] is not None]
    (r,) = rows_of(spark, sf, "bootstrap_ci")
    mean = sum(v) / len(v)
    wide = 1.96 * (sum((x - mean) ** 2 for x in v) / len(v) / len(v)) ** 0.5
    assert r["mean"] == pytest.approx(mean) and r["lo"] < mean < r["hi"]
    assert 0.6 * wide < mean - r["lo"] < 1.5 * wide and 0.6 * wide < r["hi"] - mean < 1.5 * wide


def test_exclusions(spark, sf):
    want, lost = collections.Counter(), collections.Counter()
    for r in queries._labelled(spark, sf).collect():
        evidential = not any(x.startswith("non-evidential") for x in r["issues"])
        if not (evidential and r["quality"] >= 0.45):
            for reason in [x.split(":")[0] for x in r["issues"]] or ["low-quality"]:
                want[reason] += 1
                lost[reason] += 1
    got = rows_of(spark, sf, "exclusion_reasons")
    assert {r["reason"]: r["n"] for r in got} == want and {r["reason"]: r["lost"] for r in got} == lost and want


def test_duplicates_are_demoted(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in read(spark, sf, "documents")}
    sets = {}
    for i, text in docs.items():
        w = [x.lower() for x in WORD.findall(text)]
        sets[i] = {tuple(w[k : k + 8]) for k in range(0, len(w) - 7, 2)}
    like = lambda a, b: sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])
    head = {}
    for i in sorted(docs):
        if i not in head:
            head[i] = i
            head |= {j: i for j in docs if j > i and j not in head and like(i, j)}
    want = {}
    for h in set(head.values()):
        group = [i for i in head if head[i] == h]
        keep = min(group, key=lambda i: (-len(docs[i]), i))
        want |= {i: keep for i in group if i != keep}
    got = rows_of(spark, sf, "dup_demotion")
    assert {r["chunk_id"]: int(re.search(r"duplicate-of:(\d+)", r["issues"])[1]) for r in got} == want and want
    assert not any(r["retrievable"] for r in got)


def test_heading_trails(spark, sf):
    lines = collections.defaultdict(list)
    for r in cleaning.heading_trails(cleaning.clean_lines(queries._page_markdown(spark, sf), "page_id")).collect():
        lines[r["doc"]].append(r)
    want = []
    for doc, some in lines.items():
        held = {}
        for r in sorted(some, key=lambda r: r["pos"]):
            if r["level"]:
                held = {k: v for k, v in held.items() if k < r["level"]} | {r["level"]: r["text"]}
                want.append((doc, r["pos"], r["level"], r["text"], " > ".join(held[k] for k in sorted(held))))
    assert sorted(tuple(r) for r in rows_of(spark, sf, "heading_trail")) == sorted(want) and want


def test_cleaned_lines(spark, sf):
    raw = {r["page_id"]: r["text"] for r in queries._page_markdown(spark, sf).collect()}
    heads = {(r["doc"], r["bare"]) for r in cleaning.running_heads(cleaning.lines(queries._page_markdown(spark, sf), "page_id")).collect()}
    kept = collections.defaultdict(list)
    for r in rows_of(spark, sf, "clean_page_lines"):
        kept[r["doc"]].append(r)
    squeeze = lambda x: re.sub(r"[\s*_#]+", "", x)
    assert len(kept) > 10
    for doc, some in kept.items():
        have = {squeeze(x) for x in raw[doc].split("\n")}
        for r in some:
            assert squeeze(r["text"]) in have and (doc, r["text"]) not in heads


def test_chunks(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, sf, "documents")}
    by = collections.defaultdict(list)
    for r in rows_of(spark, sf, "chunker"):
        by[r["doc"]].append(r)
    # Texts that are long enough have chunks, numbered without gaps, of bounded length, whose words are the text's in order.
    assert {i for i, t in texts.items() if len(t) > 3 * cleaning.MIN_CHARS and max(map(len, t.split())) < 100} - set(by) <= {i for i in texts if len(set(texts[i].split("\n"))) < 5}
    for i, some in by.items():
        some.sort(key=lambda r: r["chunk"])
        assert [r["chunk"] for r in some] == list(range(len(some)))
        words = texts[i].split()
        for r in some:
            assert cleaning.MIN_CHARS <= len(r["text"]) <= cleaning.MAX_CHARS + 1
            assert set(r["text"].split()) <= set(words) | {x for w in words if len(w) > cleaning.MAX_CHARS for x in r["text"].split()}


def test_work_matches(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    works = p.select("p_partkey", tx.surname(F.col("p_brand")).alias("sn"), tx.fold(F.concat_ws(" ", "p_name", "p_type")).alias("tf"), cl.title_tokens(F.concat_ws(" ", "p_name", "p_type")).alias("tt"), (F.lit(1900) + F.col("p_size")).alias("year")).collect()
    ids = cl.corpus_identities(p.select(F.col("p_type").alias("source"), F.col("p_type").alias("title"), F.col("p_brand").alias("author"), (F.lit(1900) + F.col("p_size")).alias("year"), F.col("p_name").alias("alias"))).collect()
    df = collections.Counter(t for i in ids for t in set(i["title_tokens"]))
    want = {}
    for w in works:
        best = None
        for i in sorted(ids, key=lambda i: i["ord"]):
            common = set(w["tt"]) & set(i["title_tokens"])
            rare = sum(df[t] == 1 for t in common)
            a, b = w["tf"], i["title_fold"]
            title = 3 if min(len(a), len(b)) >= 12 and (a in b or b in a) else 2 if rare >= 2 else 1 if rare or len(common) >= 2 else 0
            score = 3 * (a != "" and a in i["aliases"]) + title + 2 * (w["sn"] != "" and w["sn"] in i["surnames"])
            score += w["year"] in i["years"] if score else 0
            if score >= 2 and (best is None or score > best[0]):
                best = (score, i["source"])
        if best:
            want[f"W:{w['p_partkey']}"] = best[::-1]
    assert {r["work_id"]: (r["source"], r["score"]) for r in rows_of(spark, sf, "work_match")} == want and want


def test_cross_references(spark, sf):
    turns = collections.defaultdict(int)
    for r in read(spark, sf, "conversations"):
        if r["text"] is not None:
            turns[r["turn"]] += 1
    got = rows_of(spark, sf, "cross_refs")
    last = max(turns)
    for turn, n in turns.items():
        mine = [r for r in got if r["chapter"] == turn]
        back = [r for r in mine if r["direction"] == "backward" and r["target"] == turn % 7]
        ahead = [r for r in mine if r["direction"] == "forward"]
        named = [r for r in mine if r["direction"] == "explicit" and r["target"] == 3]
        assert len(back) >= n and len(ahead) >= n and len(named) >= n
        assert all((r["problem"] == "forward from the last chapter") == (turn == last) for r in ahead)
        assert all((r["problem"] == "no such chapter") == (3 not in turns) for r in named)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
