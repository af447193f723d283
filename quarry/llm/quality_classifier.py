"""Quality classifier: hashed word n-grams, follow-the-regularised-leader training.

Weights are learnt on the driver from a bounded sample of labelled rows and have a size
fixed by the feature space; scoring is one sparse dot product a document, computed over
blocks of Arrow batches.  Rows with crc32(doc_id as text) mod 5 = 0 are held out: their
labels are never read.  Only the text enters the score.

Nulls count as empty texts, which score as the bias with the feature of an end.  A null id is
not held out.  Repeated rows and ties are scored each by its text, very long texts as a whole; of
texts with one id the least is trained on, with the largest of its labels.  An empty table gives
an empty result.  Extra columns are kept; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .blocks import blocks, tidy
from .common import table
from .linear import Features, margins, sigmoid, sparse_rows, train_ftrl, training_rows

#: Bound of the training sample, in labelled rows.
MAX_TRAINING_ROWS = 10_000
FEATURES = Features(word_sizes=(1, 2), word_bits=20)
GOOD_AT = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(texts: list[str], y: np.ndarray) -> Classifier:
    return fit(sparse_rows(texts, FEATURES) if texts else [], y)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Classifier:
    """Without rows the score is 1/2; with one class, near that class."""
    if not rows:
        return Classifier(np.zeros(FEATURES.size, np.float32), 0.0)
    w, bias = train_ftrl(rows, y, FEATURES.size)
    return Classifier(w.astype(np.float32), bias)


def score(docs: DataFrame, model: Classifier, text_col: str = "text", to: str = "score") -> DataFrame:
    """docs with the probability of label 1; a column of that name is replaced."""
    docs = docs.drop(to)
    schema = T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = np.concatenate([sigmoid(margins(b, FEATURES, model.weights, model.bias)) for b in blocks(batch.column(at))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], schema.names)

    return docs.mapInArrow(tidy(run), schema)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(*training_rows(docs, table(spark, sf_dir, "labels"), "quality", FEATURES, MAX_TRAINING_ROWS, ~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"))
