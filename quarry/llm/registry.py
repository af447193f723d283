"""The training-data queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .bpe import op6_bpe
from .common import prepare
from .jaccard_join import OP2_SQL, op2_jaccard_join
from .language_model import op8_language_model
from .media import op5_media
from .merkle import OP11_SQL, op11_merkle_manifest
from .mixing import OP10_SQL, op10_mixing
from .quality_classifier import op3_quality_classifier
from .quality_rules import op1_quality_rules
from .secrets import OP9_SQL, op9_secret_scans
from .substring_dedup import op7_substring_dedup
from .vector_dedup import OP13_SQL, op13_vector_dedup
from .warc import OP4_SQL, op4_warc
from .whitening import op12_embedding_whitening


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """query, in a session whose Arrow batches are bounded."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_warc": op4_warc,
    "op5_media": op5_media,
    "op6_bpe": op6_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_model": op8_language_model,
    "op9_secret_scans": op9_secret_scans,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_vector_dedup": op13_vector_dedup,
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _prepared(f) for name, f in _QUERIES.items()}

SQL: dict[str, str] = {"op2_jaccard_join": OP2_SQL, "op4_warc": OP4_SQL, "op9_secret_scans": OP9_SQL, "op10_mixing": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op13_vector_dedup": OP13_SQL}
