"""Corpus pipeline: quality rules, quality classifier, near-dedup, pseudonyms, packing.

Each stage works on all that the one before it kept and returns the columns of the documents, but
for the last, which returns a row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cornermart.llm import packing, pii, quality_classifier, quality_rules, simhash
from cornermart.llm.common import table
from cornermart.session import materialise


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality_rules.keep(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts good."""
    return quality_classifier.keep(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Groups named by one repeated id each keep a document.
    """
    return simhash.keep_one(docs, distinct_ids=False)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pii.replace(docs, pii.trial_key(spark))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in fixed-length sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("simhash_dedup", dedup_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL: str | None = None  # the learned stages have no SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
