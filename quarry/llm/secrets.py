"""Secret scans with built-in functions only.

Base detectors are regular expressions, leftmost and non-overlapping per kind.  Match
positions come from splitting the text at the same expression: the pieces between
matches and the matches themselves alternate, so running lengths give code points.

The entropy detector looks at candidate strings (24 or more characters of the base-64
alphabets).  A window slides over each; its counters, five bits a character, change by one
entering and one leaving character, and with them the running sum of n * log2(n), so a step
costs the same whatever the length.  Candidates are judged by the class of their
characters (hex digits or base 64); allow-listed shapes are suppressed, and so are
candidates that overlap a base span.

Nulls and empty texts have no spans; a null text stays null when redacted.  Very long texts
cost time in proportion, but for the running sums, whose cost grows a little faster
(``RUN``), and the sort of spans.  Spans that tie on their start go by kind.  Repeated rows
are judged each.  Any other column is left alone, whatever its name; those named like the
result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import fresh, table

# The base detectors.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: The same detectors where the lower bound on length can be part of the expression.
ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"
HEX_LONG = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Counters of five bits hold a window of up to 31; so many fit into a long.
COUNTER_BITS, COUNTERS = 5, 12
#: Bits a character, by class.  A window of 20 has at most log2(20) = 4.32 bits; 20 random
#: hex digits have 3.4 on average and 20 random base-64 characters 4.1.
HEX_BITS, BASE64_BITS = 2.9, 3.7
#: Strings with letters and digits that are never secrets: those where no letter is next to a
#: digit (words, paths, slugs, dates), and identifiers in the 8-4-4-4-12 form.
MIXED = r"[A-Za-z][0-9]|[0-9][A-Za-z]"
IDENTIFIER = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

SPAN = "array<struct<start:int,rank:int,end:int>>"
CANDIDATES = "array<struct<start:int,rank:int,end:int,hit:string>>"
KINDS = ("assign", "access", "hex", "entropy")
#: Items that a running sum adds up one by one; such runs are then added to the sums before them.
RUN = 256


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(items: Column, size: int = RUN) -> Column:
    """An array, which isn't empty, as arrays of `size` items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda i: F.slice(items, i * size + 1, F.lit(size)))


def running(items: Column, combine, zero: Column, kind: str) -> Column:
    """What combine makes of the items up to each, the first with zero; an array that isn't empty, of numbers of that type.

    A fold copies what it has at every step, so it runs over RUN items, and again over the last of each run.
    """
    # What is appended is combined with zero once more, which changes nothing in sums and maxima.
    add = lambda acc, x: F.concat(acc, F.array(combine(F.when(F.size(acc) > 0, F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))).otherwise(zero), x).cast(kind)))
    empty = F.array().cast(f"array<{kind}>")
    last = lambda a: F.element_at(a, -1)
    inner = lambda x: F.transform(_cut(x), lambda run: F.aggregate(run, empty, add))
    before = lambda runs: F.concat(F.array(zero.cast(kind)), F.aggregate(F.transform(runs, last), empty, add))
    joined = lambda runs: F.flatten(F.zip_with(runs, F.slice(before(runs), F.lit(1), F.size(runs)), lambda run, base: F.transform(run, lambda x: combine(base, x).cast(kind))))
    return _let(items, lambda x: _let(inner(x), joined))


def running_sums(items: Column, kind: str = "int") -> Column:
    return running(items, lambda a, b: a + b, F.lit(0), kind)


def _found(text: Column, pattern: str, rank: int, least_value: int = 0, with_hit: bool = False) -> Column:
    """Spans of the matches; least_value: characters that the second group must have."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least_value else hits
    rows = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
    ends = lambda r: running_sums(F.transform(r, lambda x: F.length(x["gap"]) + F.length(x["hit"])))

    def span(x: Column, end: Column) -> Column:
        fields = [(end - F.length(x["hit"])).alias("start"), F.lit(rank).alias("rank"), end.alias("end")]
        if least_value:
            fields.append((F.length(x["value"]) >= least_value).alias("ok"))
        return F.struct(*fields, *([x["hit"].alias("hit")] if with_hit else []))

    out = _let(rows, lambda r: F.zip_with(r, ends(r), span))
    if least_value:
        out = F.transform(F.filter(out, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))
    kind = CANDIDATES if with_hit else SPAN
    return F.when(text.rlike(pattern), out.cast(kind)).otherwise(F.array().cast(kind))


def _times_log(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def max_window_entropy(s: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits a character, of any window of s, a string over ALPHABET (shorter strings: 0)."""
    codes = F.transform(F.split(s, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    words = -(-len(ALPHABET) // COUNTERS)
    word = lambda c: F.floor(c / COUNTERS).cast("int")
    bit = lambda c: (F.pmod(c, F.lit(COUNTERS)) * COUNTER_BITS).cast("int")
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), bit(c))

    def count(acc: Column, c: Column) -> Column:
        n = F.element_at(acc["n"], word(c) + 1)
        return F.call_function("shiftright", n, bit(c)).bitwiseAND(F.lit((1 << COUNTER_BITS) - 1).cast("long"))

    def step(acc: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        full = old >= 0
        kept = full & (old == new)
        n_new = count(acc, new)
        n_old = F.when(full, count(acc, F.greatest(old, F.lit(0)))).otherwise(F.lit(0).cast("long"))
        # One character enters and, once the window is full, one leaves.
        change = F.when(kept, F.lit(0.0)).otherwise(_times_log(n_new + 1) - _times_log(n_new) + F.when(full, _times_log(n_old - 1) - _times_log(n_old)).otherwise(F.lit(0.0)))
        move = lambda v, j: v + F.when(j == word(new), one(new)).otherwise(F.lit(0).cast("long")) - F.when(full & (j == word(old)), one(old)).otherwise(F.lit(0).cast("long"))
        at, total = acc["at"] + 1, acc["sum"] + change
        best = F.when(at >= window, F.greatest(acc["best"], F.log2(F.lit(float(window))) - total / float(window))).otherwise(acc["best"])
        return F.struct(F.when(kept, acc["n"]).otherwise(F.transform(acc["n"], move)).alias("n"), total.alias("sum"), best.alias("best"), at.alias("at"))

    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), words).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("at"))
    pairs = lambda c: F.zip_with(c, F.concat(F.array_repeat(F.lit(-1), window), F.slice(c, F.lit(1), F.size(c) - window)), lambda new, old: F.struct(new.alias("new"), old.alias("old")))
    return F.when(F.length(s) >= window, F.aggregate(_let(codes, pairs), zero, step, lambda a: a["best"])).otherwise(F.lit(0.0))


def is_secret_string(s: Column) -> Column:
    """A candidate of high entropy for its class and not of an allow-listed shape."""
    hex_ = s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    bits = F.when(hex_, F.lit(HEX_BITS)).otherwise(F.lit(BASE64_BITS))
    return s.rlike(MIXED) & ~s.rlike(IDENTIFIER) & (max_window_entropy(s) >= bits)


def _clear(candidates: Column, base: Column) -> Column:
    """Candidates, which are disjoint and in order, that overlap no base span.

    Of all starts and ends in order, those of base spans are counted: a candidate is clear if as many
    base spans start before its end as end at its start or before.
    """
    event = lambda at, order, n: F.struct(at.alias("at"), F.lit(order).alias("order"), F.lit(n).cast("long").alias("n"))
    start = 1 << 32
    marks = lambda c, b: F.array_sort(
        F.concat(
            F.transform(b, lambda x: event(x["end"], 0, 1)), F.transform(c, lambda x: event(x["start"], 1, 0)), F.transform(c, lambda x: event(x["end"], 1, 0)), F.transform(b, lambda x: event(x["start"], 2, start))
        )
    )
    counts = lambda m: running_sums(F.transform(m, lambda x: x["n"]), "bigint")
    asked = lambda m: F.transform(F.filter(F.arrays_zip(m.alias("m"), counts(m).alias("n")), lambda x: x["m"]["order"] == 1), lambda x: x["n"])
    started, ended = lambda n: F.floor(n / start), lambda n: F.pmod(n, F.lit(start).cast("long"))
    kept = lambda c, q: F.filter(c, lambda x, i: started(F.element_at(q, 2 * i + 2)) == ended(F.element_at(q, 2 * i + 1)))
    some = _let(_let(marks(candidates, base), asked), lambda q: kept(candidates, q))
    return F.when((F.size(candidates) > 0) & (F.size(base) > 0), some).otherwise(candidates)


def scan(docs: DataFrame, text_col: str = "text", base_to: str = "secret_base", spans_to: str = "secret_spans") -> DataFrame:
    """docs with base_to and spans_to: arrays of (start, rank, end) in order of start, then kind."""
    docs = docs.drop(base_to, spans_to)
    found, candidates = fresh(docs, "found"), fresh(docs, "candidates")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array_sort(F.concat(_found(text, ASSIGN, 0, ASSIGN_VALUE), _found(text, ACCESS_LONG, 1), _found(text, HEX_LONG, 2)))
    extra = F.filter(_clear(F.col(candidates), F.col(base_to)), lambda c: is_secret_string(c["hit"]))
    extra = F.transform(extra, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end")))
    return (
        docs.withColumn(base_to, base).withColumn(candidates, _found(text, CANDIDATE, 3, with_hit=True))
        .withColumn(found, F.when(F.size(candidates) > 0, extra).otherwise(F.array().cast(SPAN)))
        .withColumn(spans_to, F.array_sort(F.concat(base_to, found))).drop(found, candidates)
    )


def written_spans(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: str, mark: str = "[SECRET]") -> Column:
    """text with each span replaced; overlapping spans become one mark, neighbours one each."""
    # Each span with the end of all before it; text is cut out for RUN spans at once, for a substring costs its place.
    ends = lambda s: running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0), "int")
    with_past = lambda s, e: F.zip_with(s, F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.size(e) - 1)), lambda x, past: F.struct(x["start"].alias("start"), past.alias("past")))

    def of_run(run: Column) -> Column:
        first, stop = F.element_at(run, 1)["past"], F.array_max(F.transform(run, lambda x: F.greatest(x["start"], x["past"])))
        piece = lambda t: F.transform(run, lambda x: F.concat(F.substring(t, x["past"] - first + 1, F.greatest(x["start"] - x["past"], F.lit(0))), F.when(x["start"] >= x["past"], F.lit(mark)).otherwise(F.lit(""))))
        return _let(F.substring(text, first + 1, stop - first), lambda t: F.array_join(piece(t), ""))

    body = lambda s, e: F.concat(F.array_join(F.transform(_cut(with_past(s, e)), of_run), ""), F.substring(text, F.element_at(e, -1) + 1, F.length(text)))
    return F.when(F.size(spans) > 0, _let(ends(F.col(spans)), lambda e: body(F.col(spans), e))).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """docs with every secret in the text replaced by a mark, and the size column brought up to date."""
    base, spans = fresh(docs, "base"), fresh(docs, "spans")
    out = scan(docs, text_col, base, spans).withColumn(text_col, redacted(F.col(text_col), spans))
    if size_col in docs.columns:
        out = out.withColumn(size_col, F.when(F.size(spans) > 0, F.length(text_col).cast(docs.schema[size_col].dataType)).otherwise(F.col(size_col)))
    return out.select(*docs.columns)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda r: F.size(F.filter("secret_base", lambda x: x["rank"] == r)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(written_spans("secret_base"), 256).alias("base_sha256"), written_spans("secret_spans").alias("spans"))


def _matches(pattern: str, rank: int, value: bool = False) -> str:
    p = pattern.replace("'", "''")
    keep = f"regexp_extract_all(t, '{p}', 2)" if value else "NULL"
    return f"SELECT row AS doc_id, {rank} AS rank, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g, {keep} AS v FROM d"


OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id AS id, coalesce(text, '') AS t FROM documents),
a AS ({_matches(ASSIGN, 0, True)} UNION ALL {_matches(ACCESS, 1)} UNION ALL {_matches(HEX, 2)} UNION ALL {_matches(CANDIDATE, 3)}),
h AS (SELECT doc_id, rank, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS hit, unnest(g[1:len(m)]) AS gap, unnest(CASE WHEN v IS NULL THEN m ELSE v END) AS v FROM a),
p AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS e FROM h),
s AS (SELECT doc_id, rank, hit, e - length(hit) AS s, e FROM p
      WHERE rank = 3 OR (rank = 0 AND length(v) >= {ASSIGN_VALUE}) OR (rank = 1 AND length(hit) >= 20) OR (rank = 2 AND length(hit) >= 24)),
c AS (SELECT * FROM s x WHERE rank = 3 AND regexp_matches(hit, '{MIXED}') AND NOT regexp_matches(hit, '{IDENTIFIER}')
      AND NOT EXISTS (SELECT 1 FROM s y WHERE y.rank < 3 AND y.doc_id = x.doc_id AND y.s < x.e AND x.s < y.e)),
w AS (SELECT doc_id, hit, s, e, k, string_split(substr(hit, k, {WINDOW}), '') AS ch FROM (SELECT *, unnest(range(1, length(hit) - {WINDOW} + 2)) AS k FROM c)),
n AS (SELECT doc_id, hit, s, e, k, one, count(*) AS n FROM (SELECT * EXCLUDE (ch), unnest(ch) AS one FROM w) GROUP BY doc_id, hit, s, e, k, one),
b AS (SELECT doc_id, hit, s, e, k, log2({WINDOW}.0) - sum(n * log2(n)) / {WINDOW}.0 AS bits FROM n GROUP BY doc_id, hit, s, e, k),
x AS (SELECT doc_id, 3 AS rank, hit, s, e FROM b GROUP BY doc_id, hit, s, e
      HAVING max(bits) >= CASE WHEN regexp_full_match(hit, '[0-9a-f]+|[0-9A-F]+') THEN {HEX_BITS} ELSE {BASE64_BITS} END),
f AS (SELECT doc_id, rank, s, e, ['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || s || ':' || e AS w FROM (SELECT doc_id, rank, s, e FROM s WHERE rank < 3 UNION ALL SELECT doc_id, rank, s, e FROM x)),
o AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
        coalesce(string_agg(w, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base, string_agg(w, ',' ORDER BY s, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.id AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o ON o.doc_id = d.row
"""
