"""Corpus pipeline: toxicity, language ID, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's ``docs``. The filters keep the columns of documents and drop what
their operator rejects among the rows they are given; what they learn, they learn from those
rows. The last stage returns the packed pieces. Repeated rows, nulls, empty texts and empty
tables are treated as each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.llm import decontamination, jaccard, language_id, packing, toxicity
from podium.llm.common import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.clean(docs, language_id.train(docs))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the lowest doc_id."""
    return jaccard.clean(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    return packing.pack(docs, end_id=0)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Trained models, near-duplicate classes and token ids are beyond SQL; tests/llm checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
