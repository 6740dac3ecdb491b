"""A training-data pipeline: each stage takes the rows that its predecessor kept.

Texts are classified, cleaned of repeated runs of lines, freed of near copies
and of benchmark passages, then packed into sequences. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscore.llm import decontaminate, importance, line_dedup, packing, partenum, tokens
from polyscore.llm.common import stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling; texts that aren't sampled go."""
    return importance.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and texts that keep no line; n_chars follows the text."""
    rows = line_dedup.dedup_rows(docs)
    rows = rows.where("n_deleted = 0 or n_deleted < n_lines")
    changed = F.col("n_deleted") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("original.text")),
           "n_chars": F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("original.n_chars"))}
    return rows.select(*[(new[c] if c in new else F.col(f"original.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies stays."""
    return partenum.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a window of a benchmark item go."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts and their places in sequences."""
    return packing.pack_documents(docs, tokens.default_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express the hashed models and fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
