"""Quality rules: fixed limits on counts, then a calibrated n-gram classifier.

The classifier is a logistic regression on hashed word and character n-grams, trained
on the driver from a bounded sample of labelled rows.  A fifth of the sample is set
aside to calibrate its margin into a probability (Platt).  Its weights, whose size is
fixed by the feature space, go to executors with the code; texts are scored a block of
an Arrow batch at a time and compared with a fixed threshold.

Nulls count as empty texts, which fail the base rules.  Without labelled rows of both
classes the classifier passes everything.  Every input row gives one output row: repeated
rows are judged each, very long texts as a whole.  A null or repeated id bears on training
only, where a null id has no label and of texts with one id the least stands for it; a label
that is repeated counts as its largest value.  Extra columns are kept; those named like the
result are replaced, unless a prefix sets them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .blocks import Block, blocks, counts, give_back, grams, IS_SPACE, mix, run_hashes, spans, tidy, words
from .common import table
from .linear import Features, fit_platt, margins, sigmoid, sparse_rows, train_adagrad, training_rows

#: Bound of the training sample, in labelled rows.
MAX_TRAINING_ROWS = 4000
FEATURES = Features(word_sizes=(1, 2), char_sizes=(3, 4))
#: A text is kept if the calibrated probability of good quality is at least this.
KEEP_AT = 0.3
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    scale: float
    shift: float

    def probabilities(self, b: Block, word_table=None) -> np.ndarray:
        return sigmoid(self.scale * margins(b, FEATURES, self.weights, self.bias, word_table) + self.shift)


def train(texts: list[str], y: np.ndarray) -> QualityModel | None:
    return fit(sparse_rows(texts, FEATURES) if texts else [], y)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> QualityModel | None:
    """None where a class is absent."""
    if len(set(y.tolist())) < 2:
        return None
    held = np.arange(len(rows)) % 5 == 0
    w, bias = train_adagrad([r for r, h in zip(rows, held, strict=True) if not h], y[~held], FEATURES.size)
    z = np.array([bias + w[f] @ v for (f, v), h in zip(rows, held, strict=True) if h])
    return QualityModel(w.astype(np.float32), bias, *fit_platt(z, y[held]))


def base_counts(b: Block, word_table=None) -> dict[str, np.ndarray]:
    h, doc, starts, ends = words(b) if word_table is None else word_table
    n_words = counts(doc, b.n)
    # Code points are the bytes that continue none.
    points = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum((b.data & 0xC0) != 0x80, out=points[1:])
    word_chars = counts(doc, b.n, (points[ends] - points[starts]).astype(float)).astype(np.int64)
    symbols = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(IS_SYMBOL[b.data], out=symbols[1:])
    n_symbols = symbols[b.offsets[1:]] - symbols[b.offsets[:-1]]

    # Lines with a word, by hash of their bytes: all but the first of equal ones in a text.
    l_start, l_end, l_doc = spans(b, b.data != 10)
    inside = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(~IS_SPACE[b.data], out=inside[1:])
    with_word = inside[l_end] > inside[l_start]
    l_start, l_end, l_doc = l_start[with_word], l_end[with_word], l_doc[with_word]
    key = mix(run_hashes(b.data, l_start, l_end) ^ mix(l_doc.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    n_dup_lines = counts(l_doc, b.n) - counts(l_doc[first], b.n)

    g, at = grams(h, doc, REPEAT_WINDOW)
    key = mix(g ^ mix(doc[at].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[repeated], 1)
    np.add.at(cover, at[repeated] + REPEAT_WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": counts(doc[covered], b.n)}


RULES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("quality_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]
)


def judge(docs: DataFrame, model: QualityModel | None, text_col: str = "text", keep_at: float = KEEP_AT, prefix: str = "") -> DataFrame:
    """docs with the columns of RULES, their names after the prefix; columns of those names that docs has are replaced."""
    docs = docs.drop(*[prefix + n for n in RULES.names])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(prefix + f.name, f.dataType) for f in RULES.fields]])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for b in blocks(batch.column(at)):
                wt = words(b)
                c = base_counts(b, wt)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                p = model.probabilities(b, wt) if model else np.ones(b.n)
                parts.append([*[c[n].astype(np.int64) for n in RULES.names[:5]], failed, p, ~failed & (p >= keep_at)])
            if parts:
                cols = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *cols], schema.names)

    return docs.mapInArrow(tidy(run), schema)


def model_for(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    try:
        return fit(*training_rows(docs, labels, "quality", FEATURES, MAX_TRAINING_ROWS))
    finally:
        # The driver lives on as workers do, and would hold the sample's memory through all stages.
        give_back()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, model_for(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *RULES.names)
