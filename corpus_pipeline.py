"""From raw documents to a tokenized training mix, stage by stage.

Quality classifier, exact dedup, near dedup, mixing and encoding, in this order. Each stage
takes the rows that its predecessor kept, with the columns of ``documents``, and its decisions
take effect: rejected documents and copies go, the mix repeats what it takes twice.

Cases: null and empty texts go through every stage by the rules of its operator; an empty
table gives an empty result; further columns are carried along up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textpulse.llm import line_crf
from textpulse.llm.common import written
from textpulse.llm.jaccard_join import one_of_each
from textpulse.llm.pareto_mix import mix_rows
from textpulse.llm.piece_sampling import segmentation_report
from textpulse.llm.radix_dedup import deduplicate

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; it learns from the given labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.accepted(docs, line_crf.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the smallest id."""
    return deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts stays: the smallest id."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row of the mix and of its sampled segmentations."""
    return segmentation_report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing_sources", mix),
    ("sentencepiece", encode),
]

# The first stage is trained and the last one sampled; SQL has no form for them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
