"""From raw documents to packed training sequences.

Four stages, each one of the corpus operators; every stage works on all rows that
the one before it kept, written as Parquet and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recoloom.llm import mil_quality, packing, quality_rules, simhash
from recoloom.llm.common import stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score >= 0.3); it learns from the
    labels of ``docs`` outside its held-out fold."""
    return mil_quality.accepted(docs, mil_quality.fit(docs, table(spark, sf_dir, "labels")))


def rule_votes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are probably good by the rules' votes."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rule_votes),
          ("simhash_near_dedup", near_duplicates), ("packing", pack)]

#: The classifier, the estimated posteriors and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
