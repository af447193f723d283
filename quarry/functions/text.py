"""Text functions as Column expressions: normalisation, tokens, patterns.

Java's \\w is ASCII, so letters, marks and digits are spelled as \\p classes throughout.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
import regex as re
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Patterns and rewrites that results depend on.
WORD = r"\p{L}[\p{L}\p{N}\p{M}_'’-]+"
TOKEN = r"[\p{L}\p{N}]+"
NUMERAL = r"\b\d{1,4}(?:[–\-/]\d{1,4})?\b"
NUMBER = r"-?\d[\d,]*(?:\.\d+)?"
DEVANAGARI = r"[\x{0900}-\x{097F}]"
AUXILIARIES = r"\b(?:was|were|is|are|has|have|had|been|being)\b"
SENTENCE_START = ".!?:;|—-"
STOP_TERMS = (
    "the a an and or of in at on to for by its their his her this that these those with "
    "from but not was were are is be been as sanskrit hindu indian india chapter section figure "
    "how what why when where did does do which who"
).split()
DIGRAPHS = (
    ("sh", "s"), ("ch", "c"), ("kh", "k"), ("th", "t"), ("ph", "p"), ("bh", "b"), ("dh", "d"), ("gh", "g"),
    ("jh", "j"), ("ee", "i"), ("oo", "u"), ("aa", "a"), ("ii", "i"), ("uu", "u"), ("w", "v"),
)
#: Latin letters with marks and their base letters: what decomposition and dropping of marks give.
MARKED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįñńňṇṅòóôõöōőṛŕřśşšṣṭťùúûüūůűýÿžźżḍḥṃḷṁṝḹ"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiinnnnnooooooorrrssssttuuuuuuuyyzzzdhmlmrl"
#: Devanagari letters and signs, and their letters in the scholarly Latin transliteration.
SIGNS = "अआइईउऊऋॠऌॡएओािीुूृॄॢॣेोकगङचजञटडणतदनपबमयरलवशषसहळंःऽ०१२३४५६७८९"
LETTERS = "aāiīuūṛṝḷḹeoāiīuūṛṝḷḹeokgṅcjñṭḍṇtdnpbmyrlvśṣshḷṃḥ'0123456789"
SIGN_PAIRS = (
    ("ख", "kh"), ("घ", "gh"), ("छ", "ch"), ("झ", "jh"), ("ठ", "ṭh"), ("ढ", "ḍh"), ("थ", "th"), ("ध", "dh"), ("फ", "ph"), ("भ", "bh"), ("ऐ", "ai"), ("औ", "au"), ("ै", "ai"), ("ौ", "au"), ("ँ", "m̐"),
)


def let(value: Column, use) -> Column:
    """use(value) with value computed once a row: inside lambdas an expression would be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """c without white space at its ends."""
    return F.btrim(c, F.lit(" \t\r\n\x0b\x0c"))


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def words(c: Column) -> Column:
    return F.regexp_extract_all(empty_if_null(c), F.lit(f"({WORD})"), F.lit(1))


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(empty_if_null(c)), F.lit(f"({TOKEN})"), F.lit(1))


def strip_marks(c: Column) -> Column:
    """Lower case without the marks of Latin letters (the Column form of NFKD and dropping combining marks)."""
    return F.regexp_replace(F.translate(F.lower(c), MARKED, PLAIN), r"\p{M}", "")


@F.pandas_udf(StringType())
def nfkd_strip(s: pd.Series) -> pd.Series:
    """Lower case after compatibility decomposition and without combining marks, for letters that strip_marks doesn't know."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower())


def deva_to_latin(c: Column) -> Column:
    """Devanagari in Latin letters; other text stays.

    A consonant that neither a vowel sign nor a mark of silence follows has an inherent a.
    """
    s = F.regexp_replace(c, r"([\x{0915}-\x{0939}]\x{093C}?)(?![\x{093C}\x{093E}-\x{094D}\x{0962}\x{0963}])", "$1a")
    s = F.regexp_replace(s, r"[\x{094D}\x{093C}]", "")
    s = reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), SIGN_PAIRS, s)
    return F.when(has_devanagari(c), F.translate(s, SIGNS, LETTERS)).otherwise(c)


def depossess(c: Column) -> Column:
    return F.regexp_replace(c, r"['’]s\b|['’](?![\p{L}\p{N}_])|['’]$", "")


def fold(c: Column) -> Column:
    """A key under which spellings of one name meet, in either script: marks, digraphs, doubled letters and punctuation go."""
    s = F.replace(strip_marks(deva_to_latin(depossess(c))), F.lit("'"))
    s = reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), DIGRAPHS, s)
    return F.regexp_replace(F.regexp_replace(s, r"(.)\1+", "$1"), "[^a-z0-9]", "")


def folded_words(c: Column) -> Column:
    return F.filter(F.transform(words(c), fold), lambda x: x != "")


def fold_text(c: Column) -> Column:
    return F.array_join(folded_words(c), " ")


def folded_tokens(c: Column) -> Column:
    """The distinct folded words."""
    return F.array_distinct(folded_words(c))


def loose_key(folded: Column) -> Column:
    return F.regexp_replace(folded, "a$", "")


def numerals(c: Column) -> Column:
    return F.regexp_extract_all(empty_if_null(c), F.lit(f"({NUMERAL})"), F.lit(1))


def numbers(c: Column) -> Column:
    """Distinct numbers, without thousands separators."""
    return F.array_distinct(F.transform(F.regexp_extract_all(empty_if_null(c), F.lit(f"({NUMBER})"), F.lit(1)), lambda x: F.replace(x, F.lit(","))))


def has_devanagari(c: Column) -> Column:
    return c.rlike(DEVANAGARI)


def _lines(c: Column, keep) -> Column:
    return F.array_join(F.filter(F.split(empty_if_null(c), "\n"), keep), "\n")


def strip_devanagari(c: Column) -> Column:
    return _lines(c, lambda x: (F.trim(x) != "") & ~has_devanagari(x))


def devanagari_only(c: Column) -> Column:
    return _lines(c, has_devanagari)


def proper_nouns(c: Column, stop: list[str] = STOP_TERMS) -> Column:
    """Capitalised words that don't start a sentence, first spellings in order.

    A word of three or more letters that starts with a capital counts if what stands before it, blanks aside, is
    neither empty nor ends in a mark after which sentences start.  Runs of blanks are made one first.
    """
    text = F.regexp_replace(empty_if_null(c), r"\s{2,}", " ")
    letter = r"\p{L}\p{N}\p{M}_'’"
    # The capital is looked for before what stands on its left, which is dear at every place of a text.
    inner = F.regexp_extract_all(text, F.lit(rf"(?=\p{{Lu}})(?<=[^\s{SENTENCE_START}]\s|[^\s{letter}{SENTENCE_START}])(\p{{Lu}}[{letter}-]{{2,}})"), F.lit(1))

    def firsts(of: Column) -> Column:
        return F.filter(of, lambda x, i: (i == 0) | (x["low"] != F.get(of, i - 1)["low"]))

    found = F.filter(F.array_distinct(inner), lambda w: ~F.lower(w).isin(stop))
    placed = F.array_sort(F.transform(found, lambda w, i: F.struct(F.lower(w).alias("low"), i.alias("i"), w.alias("w"))))
    return F.transform(F.array_sort(F.transform(let(placed, firsts), lambda x: F.struct(x["i"].alias("i"), x["w"].alias("w")))), lambda x: x["w"])


def predicate_key(c: Column) -> Column:
    """Distinct words of a predicate without auxiliaries, sorted; the first three name the relation."""
    s = F.regexp_replace(F.regexp_replace(F.lower(empty_if_null(c)), AUXILIARIES, " "), "[^a-z ]", " ")
    return F.slice(F.array_sort(F.array_distinct(F.filter(F.split(s, " +"), lambda x: x != ""))), 1, 3)


def claim_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.lower(F.concat_ws("|", *[empty_if_null(p.cast("string")) for p in parts])).cast("binary")), 1, 16)


def query_hash(c: Column) -> Column:
    return F.substring(F.sha1(F.lower(F.trim(c)).cast("binary")), 1, 16)


def work_key(author: Column, title: Column, year: Column) -> Column:
    parts = F.concat_ws("|", F.substring(fold(empty_if_null(author)), 1, 24), F.substring(fold(empty_if_null(title)), 1, 48), empty_if_null(year.cast("string")))
    return F.concat(F.lit("W:"), F.substring(F.sha2(parts, 256), 1, 16))


def surname(author: Column) -> Column:
    """Of the first author: what stands before a comma, else the last word of two or more letters; folded."""
    first = F.trim(F.element_at(F.split(empty_if_null(author), r"\s+(?:and|&)\s+|;"), 1))
    last = F.element_at(F.concat(F.array(F.lit("")), F.filter(F.split(first, r"\s+"), lambda x: F.length(x) > 1)), -1)
    return fold(F.when(first.contains(","), F.element_at(F.split(first, ","), 1)).otherwise(last))


def as_text(items: Column) -> Column:
    return F.coalesce(F.array_join(items, "; "), F.lit(""))


def endnote(short: Column, trail: Column, page_from: Column, page_to: Column) -> Column:
    """short, 'last heading', p. n or pp. n-m."""
    last = F.substring(F.element_at(F.split(trail, " > "), -1), 1, 80)
    pages = F.when(page_from.isNull(), None).when(page_to.isNull() | (page_to == page_from), F.concat(F.lit("p. "), page_from)).otherwise(F.concat(F.lit("pp. "), page_from, F.lit("-"), page_to))
    return F.concat_ws(", ", short, F.when(F.coalesce(last, F.lit("")) != "", F.concat(F.lit("'"), last, F.lit("'"))), pages)


def citation_label(source: Column, trail: Column, page_from: Column, page_to: Column) -> Column:
    pages = F.when(page_from.isNull(), F.lit("")).when(page_to.isNull() | (page_to == page_from), F.concat(F.lit(", p. "), page_from)).otherwise(F.concat(F.lit(", pp. "), page_from, F.lit("-"), page_to))
    return F.trim(F.concat(F.lit("["), source, pages, F.lit("] "), empty_if_null(trail)))


def anchor(heading: Column) -> Column:
    """A heading as a link target."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(heading)), r"[^\p{L}\p{N}\s-]", ""), r"\s+", "-")


def dehyphenate(c: Column) -> Column:
    return F.regexp_replace(c, r"([\p{L}\p{N}_])[-­]\s*\n\s*([\p{L}\p{N}_])", "$1$2")


def word_shingles(c: Column, k: int = 8, stride: int = 2) -> Column:
    """Hashes of every stride-th run of k words, distinct; none for texts with fewer."""
    def of(w: Column) -> Column:
        at = lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, k), " "))
        return F.when(F.size(w) >= k, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - k, F.lit(stride)), at))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(c), lambda x: F.lower(x)), of)


def page_stamp(c: Column) -> Column:
    """k=v pairs of a stamp comment."""
    return F.str_to_map(F.regexp_extract(c, r"<!--\s*stamp:?\s*([^>]*?)\s*-->", 1), F.lit(" "), F.lit("="))


def text_health(c: Column) -> Column:
    """Lengths and counts that tell whether a conversion went well."""
    t = empty_if_null(c)
    return F.struct(
        F.length(t).alias("chars"), F.regexp_count(t, F.lit(DEVANAGARI)).alias("devanagari"),
        F.regexp_count(t, F.lit("[āīūṛṝḷṃḥṅñṭḍṇśṣĀĪŪṚṬḌṆŚṢ]")).alias("iast"), F.regexp_count(t, F.lit("Ã|â€|�")).alias("mojibake"),
    )


# ---- words of an index --------------------------------------------------------------------------

#: Latin letters with marks, lower case, and their base letters: by decomposition, over the blocks that hold them.
_FOLDED = {c: d[0] for c in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))) if c == c.lower() and (d := unicodedata.normalize("NFD", c)) != c and d[0].isascii()}
ACCENTED, BASES = "".join(_FOLDED), "".join(_FOLDED.values())
# Marks that a word may go on with (Latin and Devanagari marks, joiners).
WORD_MARKS = r"\x{0300}-\x{036F}\x{0900}-\x{0903}\x{093A}-\x{094F}\x{0951}-\x{0957}\x{0962}\x{0963}\x{200C}\x{200D}"
MARKED_WORD = rf"[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}_{WORD_MARKS}]*"


def undiacritic(c: Column) -> Column:
    """Lower case, Latin letters without their marks; other marks stay."""
    return F.regexp_replace(F.translate(F.lower(c), ACCENTED, BASES), r"[\x{0300}-\x{036F}]", "")


def index_tokens(c: Column) -> Column:
    """What an index holds of a text, in order: runs of letters and digits without Latin marks.  Marks of other scripts part them."""
    return F.regexp_extract_all(undiacritic(empty_if_null(c)), F.lit(f"({TOKEN})"), F.lit(1))


def marked_words(c: Column) -> Column:
    """Words with their marks, as one asks for them; in an index each is one token or several that stand side by side."""
    return F.regexp_extract_all(empty_if_null(c), F.lit(f"({MARKED_WORD})"), F.lit(1))


# ---- folding of single words in tasks -----------------------------------------------------------

_POSSESSIVE = re.compile(r"['’]s(?![\p{L}\p{N}\p{Mn}_])|['’](?![\p{L}\p{N}_])|['’]$")
_INHERENT = re.compile("([क-ह]़?)(?![़ा-्ॢॣ])")
_MARK, _DOUBLED, _OTHER = re.compile(r"\p{M}"), re.compile(r"(.)\1+"), re.compile("[^a-z0-9]")
_PLAIN_MAP, _SIGN_MAP = str.maketrans(MARKED, PLAIN), str.maketrans(SIGNS, LETTERS)


def fold_word(w: str) -> str:
    """fold() of a word as a Python function, for tasks that fold each distinct word once."""
    s = _POSSESSIVE.sub("", w)
    if any("ऀ" <= c <= "ॿ" for c in s):
        s = _INHERENT.sub(r"\1a", s).replace("्", "").replace("़", "")
        for a, b in SIGN_PAIRS:
            s = s.replace(a, b)
        s = s.translate(_SIGN_MAP)
    s = s.lower()
    if not s.isascii():
        s = _MARK.sub("", s.translate(_PLAIN_MAP))
    s = s.replace("'", "")
    for a, b in DIGRAPHS:
        s = s.replace(a, b)
    return _OTHER.sub("", _DOUBLED.sub(r"\1", s))
