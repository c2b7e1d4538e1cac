"""The operators over the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textpulse.llm.byte_shards import balanced_shards
from textpulse.llm.common import table
from textpulse.llm import line_crf, page_text, toxicity
from textpulse.llm.hard_negatives import hard_negatives
from textpulse.llm.isolation_rules import judge
from textpulse.llm.jaccard_join import near_duplicates
from textpulse.llm.pareto_mix import mix_documents
from textpulse.llm.piece_sampling import segmentation_report
from textpulse.llm.radix_dedup import exact_duplicates
from textpulse.llm.secret_scan import scan_secrets
from textpulse.llm.spelling_variants import spelling_variants
from textpulse.llm.url_cascade import judge_pages

SHARDS = 24


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation_report(table(spark, sf_dir, "documents"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository and its source the owner."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), SHARDS)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return page_text.extract(pages, page_text.train(pages))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, scorer)


def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.score_documents(docs, field)


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secret_scans": op2_secret_scans,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_sharding": op4_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_toxicity": op7_toxicity,
    "op8_mixing_sources": op8_mixing_sources,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_url_filters": op11_url_filters,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}
