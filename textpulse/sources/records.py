"""Decoding of the records that the scoring job publishes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.schemas import DEAD_LETTER, PROCESSED


def decode_processed(messages: DataFrame) -> DataFrame:
    """``value`` as a processed record; malformed text gives a row of nulls."""
    return messages.select(F.from_json("value", PROCESSED).alias("data")).select("data.*")


def decode_dead_letters(messages: DataFrame) -> DataFrame:
    """``value`` as a dead-letter record with its epoch seconds also as a timestamp."""
    rows = messages.select(F.from_json("value", DEAD_LETTER).alias("data")).select("data.*")
    return rows.withColumn("error_timestamp", F.timestamp_seconds("timestamp"))
