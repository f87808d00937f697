"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.llm import (
    decontamination,
    html_extract,
    jaccard,
    language_id,
    packing,
    phrases,
    quality,
    spelling,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from podium.llm.common import shared_path, table, written


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"),
                                         shared_path(spark, "token-files"), end_id=2)
    return token_files.token_digests(spark, path)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), end_id=0)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 0 inserts all documents with estimated counts, batch 1 revises the short ones to exact
    counts, batch 2 the others; batch 3 deletes the documents without a language and batch 4 inserts
    them again. A repeated commit changes nothing. Each text is tokenised once."""
    docs = table(spark, sf_dir, "documents")
    rollup = token_counts.Rollup(spark, shared_path(spark, "token-counts"))
    first = token_counts.estimated(docs)
    exact = written(token_counts.counted(docs), "exact-counts")
    rollup.commit(0, token_counts.signed(first, 1))
    for batch, part in ((1, "chars < 2000"), (2, "chars >= 2000")):
        rollup.commit(batch, token_counts.signed(first.where(part), -1), token_counts.signed(exact.where(part), 1))
    unknown = exact.where("lang IS NULL OR lang = 'und'")
    rollup.commit(3, token_counts.signed(unknown, -1))
    rollup.commit(4, token_counts.signed(unknown, 1))
    rollup.commit(0, token_counts.signed(first, 1))
    return rollup.totals()


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedupe(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_html_extraction, op3_url_filters, op4_toxicity, op5_ngram_jaccard_join,
    op6_token_output, op7_quality_rules, op8_packing, op9_benchmark_decontamination,
    op10_token_counts, op11_suffix_array_dedup,
    op12_phrase_collocations, op13_spelling_variants)}
