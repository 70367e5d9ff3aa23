"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``.  Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import documents, drop_stored, stored
from remitflow.llm.language_id import fit, held_out, of_known_language, training_sample
from remitflow.llm.line_dedup import dedup_lines
from remitflow.llm.packing import best_fit_packing
from remitflow.llm.secrets import redact
from remitflow.llm.simhash import one_of_each

#: A text that its own classifier rather denies than claims goes, beside those that the model finds unlike all it learned.
LEAST_SCORE = 0.3


def _with_length(docs: DataFrame) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those without a letter, and those of no learned language."""
    model = fit(training_sample(docs.where(~held_out())))
    return of_known_language(docs, model, LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; so do documents of which nothing is left."""
    left = dedup_lines(docs).where("_gone IS NULL OR size(_gone) < _lines")
    return _with_length(left.select(*docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    return _with_length(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a packed sequence."""
    return best_fit_packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", packing),
]

#: No SQL can express the stages; tests/llm/test_pipeline.py holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs, before = stored(stage(spark, docs, sf_dir), name), written
        if before is not None:
            drop_stored(before)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
