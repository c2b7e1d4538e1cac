"""Clean, score and enrich unified content.

A scorer takes a DataFrame and the name of its cleaned text column and adds
``sentiment_result``, a struct that may be null where it has no answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.functions.lexicon import DEFAULT_LEXICON, Lexicon, lexicon_hits, verdict
from textpulse.functions.text import clean_column, long_enough
from textpulse.operators.columns import evaluate_once

Scorer = Callable[[DataFrame, str], DataFrame]


def clean_content(content: DataFrame) -> DataFrame:
    """Content with ``cleaned_text``."""
    cleaned = clean_column(content, F.col("content"), "cleaned_text")
    return evaluate_once(cleaned, cleaned_text=F.col("cleaned_text"))


def drop_short(cleaned: DataFrame, config: PulseConfig = DEFAULTS) -> DataFrame:
    """Rows whose cleaned text is longer than the minimum; the others go nowhere."""
    return cleaned.filter(long_enough(F.col("cleaned_text"), config.min_text_length))


def lexicon_scorer(lexicon: Lexicon = DEFAULT_LEXICON) -> Scorer:
    def score(df: DataFrame, text: str) -> DataFrame:
        hits = lexicon_hits(F.col(text), lexicon, cleaned=True)
        result = verdict(F.col(text), F.col("_hits"), lexicon, cleaned=True)
        return (
            evaluate_once(df, _hits=hits).withColumn("sentiment_result", result).drop("_hits")
        )

    return score


def score_content(
    content: DataFrame, config: PulseConfig = DEFAULTS, scorer: Scorer | None = None
) -> DataFrame:
    """Unified content to cleaned, long enough rows with ``sentiment_result``."""
    scorer = scorer or lexicon_scorer()
    return scorer(drop_short(clean_content(content), config), "cleaned_text")


def unpack_sentiment(scored: DataFrame) -> DataFrame:
    """Rows with a result, the result as three columns."""
    kept = [name for name in scored.columns if name != "sentiment_result"]
    return scored.filter(F.col("sentiment_result").isNotNull()).select(
        *kept, "sentiment_result.*"
    )


def enrich(
    unpacked: DataFrame, config: PulseConfig = DEFAULTS, now: Column | None = None
) -> DataFrame:
    """Processing time, model version, text length and engagement, above minimum confidence."""
    return unpacked.withColumns(
        {
            "processing_timestamp": F.current_timestamp() if now is None else now,
            "model_version": F.lit(config.model_version),
            "text_length": F.length("cleaned_text"),
            "engagement_score": F.col("score"),
        }
    ).filter(F.col("confidence") >= config.min_confidence)
