"""Parse bus messages, give posts and comments one shape, and tell failures apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.functions import messages as M
from textpulse.functions.text import REMOVAL_MARKS
from textpulse.operators.columns import evaluate_once

PARSE_ERROR = "JSONParseError"
SENTIMENT_ERROR = "SentimentAnalysisError"

CONTENT_FIELDS = ("id", "content", "parent_id", "author", "subreddit", "score", "created_utc")
CONTENT_COLUMNS = ("kafka_key", "kafka_timestamp", "content_type", *CONTENT_FIELDS)


def open_envelopes(envelopes: DataFrame) -> DataFrame:
    """Bus columns under their working names, with the message as text."""
    return envelopes.select(
        F.col("key").alias("kafka_key"),
        F.col("value").cast("string").alias("json_string"),
        F.col("timestamp").alias("kafka_timestamp"),
        "content_type",
    )


def parse_messages(envelopes: DataFrame) -> DataFrame:
    """Opened envelopes plus ``parsed``: a content struct, or null if the message is invalid.

    Posts and comments go through one pass; they differ in the text field and in the parent.
    """
    is_post = F.col("content_type") == "post"
    title, body = M.text_field("document", "title"), M.text_field("document", "body")
    parent = M.text_field("document", "parent_id")
    fields = {
        "id": M.text_field("document", "id"),
        "content": F.when(is_post, title).otherwise(body),
        "parent_id": F.when(is_post, F.lit("")).otherwise(parent),
        "author": M.text_field("document", "author"),
        "subreddit": M.text_field("document", "subreddit"),
        "score": M.number_field("document", "score", "int"),
        "created_utc": M.number_field("document", "created_utc", "bigint"),
    }
    opened = open_envelopes(envelopes)
    read = opened.withColumn("document", M.parse_json(F.col("json_string"))).select(
        *opened.columns, *[value.alias(f"_{name}") for name, value in fields.items()]
    )
    valid = (
        (F.col("_id") != "")
        & (F.col("_content") != "")
        & (is_post | ~F.col("_content").isin(*REMOVAL_MARKS))
    )
    content = F.struct(*[F.col(f"_{name}").alias(name) for name in CONTENT_FIELDS])
    return evaluate_once(read, parsed=F.when(valid, content)).select(*opened.columns, "parsed")


def valid_content(parsed: DataFrame) -> DataFrame:
    """Valid messages as unified content rows."""
    return parsed.filter(F.col("parsed").isNotNull()).select(
        "kafka_key", "kafka_timestamp", "content_type", "parsed.*"
    )


def union_content(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept."""
    return posts.unionByName(comments)


def source_topic(config: PulseConfig) -> Column:
    is_post = F.col("content_type") == "post"
    return F.when(is_post, config.posts_topic).otherwise(config.comments_topic)


def parse_failures(parsed: DataFrame, config: PulseConfig = DEFAULTS) -> DataFrame:
    """Invalid messages, tagged with the topic they came from."""
    noun = F.when(F.col("content_type") == "post", "Post").otherwise("Comment")
    return parsed.filter(F.col("parsed").isNull()).select(
        F.col("json_string").alias("original_message"),
        F.lit(PARSE_ERROR).alias("error_type"),
        F.concat(F.lit("Invalid "), noun, F.lit(" JSON")).alias("error_message"),
        source_topic(config).alias("source_topic"),
    )


def sentiment_failures(scored: DataFrame) -> DataFrame:
    """Cleaned rows for which the scorer gave no result; their topic is the content type."""
    return scored.filter(F.col("sentiment_result").isNull()).select(
        F.col("cleaned_text").alias("original_message"),
        F.lit(SENTIMENT_ERROR).alias("error_type"),
        F.lit("Null sentiment result").alias("error_message"),
        F.col("content_type").alias("source_topic"),
    )


def dead_letters(failures: DataFrame, now: Column | None = None) -> DataFrame:
    """Tagged failures as dead-letter records, stamped in epoch seconds."""
    clock = F.current_timestamp() if now is None else now
    return failures.select(
        "original_message",
        "error_type",
        "error_message",
        F.unix_timestamp(clock).alias("timestamp"),
        F.lit(0).alias("retry_count"),
        F.col("source_topic").alias("topic"),
    )
