"""The corpus pipeline: raw documents in, packed token sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on what the one before it kept.  The first three return whole rows of
``documents``; the last returns one row per piece of a packed document.  ``run`` writes every stage's rows as Parquet in
the shared folder and reads them back for the next, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.best_fit import pack_documents
from llm.boosted import classifier_filter, fit
from llm.near_dedup import dedup_filter
from llm.quality_rules import quality_filter
from llm.queries import WORD_BPE, table
from llm.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the adaptive rules; limits come from these documents."""
    return quality_filter(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good.  It is trained on the labelled documents as they were before any stage,
    since the rules leave few bad ones to learn from."""
    forest = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return classifier_filter(docs, forest)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return dedup_filter(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents left, with its sequence and place."""
    return pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None      # SQL cannot express the classifier and the tokenizer; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
