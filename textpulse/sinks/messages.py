"""Rows as JSON messages, and short previews for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.schemas import PROCESSED


def encode_processed(processed: DataFrame) -> DataFrame:
    """``key`` and JSON ``value``; the text before cleaning goes as ``original_content``.

    Timestamps are written to the millisecond, and null fields are left out.
    """
    record = processed.withColumnRenamed("content", "original_content")
    value = F.to_json(F.struct(*PROCESSED.fieldNames()))
    return record.select(F.col("id").alias("key"), value.alias("value"))


def encode_dead_letters(records: DataFrame) -> DataFrame:
    """Dead-letter records as JSON ``value`` without a key."""
    return records.select(F.to_json(F.struct("*")).alias("value"))


def encode_raw(content: DataFrame, config: PulseConfig = DEFAULTS) -> DataFrame:
    """Unified content as the producer's messages, with the topic each row belongs to."""
    is_post = F.col("content_type") == "post"
    common = ["author", "subreddit", "score", "created_utc"]
    post = F.to_json(F.struct("id", F.col("content").alias("title"), *common))
    comment = F.to_json(F.struct("id", F.col("content").alias("body"), *common, "parent_id"))
    topic = F.when(is_post, config.posts_topic).otherwise(config.comments_topic)
    return content.select(
        topic.alias("topic"), F.when(is_post, post).otherwise(comment).alias("value")
    )


def result_preview(processed: DataFrame) -> DataFrame:
    return processed.select(
        "id",
        "content_type",
        F.substring("content", 1, 60).alias("content_preview"),
        "subreddit",
        "author",
        "sentiment",
        F.round("sentiment_score", 3).alias("score"),
        F.round("confidence", 3).alias("conf"),
        F.col("engagement_score").alias("engagement"),
    )


def dead_letter_preview(failures: DataFrame, now: Column | None = None) -> DataFrame:
    clock = F.current_timestamp() if now is None else now
    return failures.select(
        F.col("source_topic").alias("Topic"),
        F.col("error_type").alias("Error Type"),
        F.substring("error_message", 1, 100).alias("Error Message"),
        F.substring("original_message", 1, 50).alias("Message Preview"),
        F.timestamp_seconds(F.unix_timestamp(clock)).alias("Timestamp"),
    )


def topic_writer_options(config: PulseConfig, topic: str | None = None) -> dict[str, str]:
    """Writer options; without a topic each row names its own."""
    options = {"kafka.bootstrap.servers": config.bootstrap_servers}
    return options if topic is None else {**options, "topic": topic}


def publish(messages: DataFrame, config: PulseConfig, topic: str | None = None) -> None:
    """Send one batch of messages to the bus."""
    messages.write.format("kafka").options(**topic_writer_options(config, topic)).save()
