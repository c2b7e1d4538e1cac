"""From bus messages to processed rows and dead letters.

``route`` parses, cleans and scores every message once; ``processed_rows`` and ``failures``
select from the same frame. Nothing here starts a query, so a stream and a batch share the
plan. When only one of the two results is used, the optimizer moves its filters ahead of
the steps it does not need; when both are, keep the routed frame (``write_routed``, or the
persisted micro-batch of the streaming job) rather than reading the source twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.functions.text import clean_column, long_enough
from textpulse.operators.columns import evaluate_once
from textpulse.operators.routing import (
    dead_letters,
    parse_failures,
    parse_messages,
    sentiment_failures,
)
from textpulse.operators.scoring import Scorer, enrich, lexicon_scorer, unpack_sentiment

PROCESSED, PARSE_FAILED, SCORE_FAILED, TOO_SHORT, UNSURE = (
    "processed",
    "parse_failed",
    "score_failed",
    "too_short",
    "unsure",
)


def route(
    envelopes: DataFrame, config: PulseConfig = DEFAULTS, scorer: Scorer | None = None
) -> DataFrame:
    """Every message with ``parsed``, ``cleaned_text`` and ``sentiment_result``."""
    scorer = scorer or lexicon_scorer()
    parsed = parse_messages(envelopes)
    cleaned = clean_column(parsed, F.col("parsed.content"), "cleaned_text")
    once = evaluate_once(cleaned, cleaned_text=F.col("cleaned_text"))
    return scorer(once, "cleaned_text")


def _scorable(config: PulseConfig) -> Column:
    return F.col("parsed").isNotNull() & long_enough(
        F.col("cleaned_text"), config.min_text_length
    )


def outcome(config: PulseConfig = DEFAULTS) -> Column:
    """What becomes of a routed message; each has exactly one outcome."""
    return (
        F.when(F.col("parsed").isNull(), PARSE_FAILED)
        .when(~_scorable(config), TOO_SHORT)
        .when(F.col("sentiment_result").isNull(), SCORE_FAILED)
        .when(F.col("sentiment_result.confidence") >= config.min_confidence, PROCESSED)
        .otherwise(UNSURE)
    )


def processed_rows(
    routed: DataFrame, config: PulseConfig = DEFAULTS, now: Column | None = None
) -> DataFrame:
    kept = routed.filter(_scorable(config)).select(
        "kafka_key",
        "kafka_timestamp",
        "content_type",
        "parsed.*",
        "cleaned_text",
        "sentiment_result",
    )
    return enrich(unpack_sentiment(kept), config, now)


def failures(routed: DataFrame, config: PulseConfig = DEFAULTS) -> DataFrame:
    """Messages that failed to parse or to score, tagged.

    For a scorer that always answers, the optimizer sees that its result is never null and
    drops the second branch.
    """
    unscored = sentiment_failures(routed.filter(_scorable(config)))
    return parse_failures(routed, config).unionByName(unscored)


@dataclass(frozen=True)
class Results:
    processed: DataFrame
    dead_letters: DataFrame


def write_routed(
    envelopes: DataFrame,
    path: str,
    config: PulseConfig = DEFAULTS,
    scorer: Scorer | None = None,
) -> None:
    """One pass over the messages into a table with a folder per outcome."""
    routed = route(envelopes, config, scorer).withColumn("outcome", outcome(config))
    routed.write.mode("overwrite").partitionBy("outcome").parquet(path)


def read_results(
    spark: SparkSession,
    path: str,
    config: PulseConfig = DEFAULTS,
    now: Column | None = None,
) -> Results:
    """Processed rows and dead letters of a routed table, each from its own folders."""
    table = spark.read.parquet(path)
    kept = table.filter(F.col("outcome") == PROCESSED)
    failed = table.filter(F.col("outcome").isin(PARSE_FAILED, SCORE_FAILED))
    return Results(
        processed_rows(kept, config, now), dead_letters(failures(failed, config), now)
    )
