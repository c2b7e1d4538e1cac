"""API listings, ``{"data": {"children": [{"data": {...}}]}}``, to one message per child.

A child without a required field, or with one of the wrong JSON type, becomes a failure of
its own and leaves its siblings alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.functions.messages import parse_json, strict_integer, strict_text
from textpulse.operators.columns import evaluate_once
from textpulse.operators.routing import PARSE_ERROR

# Which fields a message has, and which may be missing.
POST_FIELDS = ("id", "title", "author", "subreddit", "score", "created_utc")
COMMENT_FIELDS = ("id", "body", "author", "subreddit", "score", "created_utc", "parent_id")
OPTIONAL_COMMENT_FIELDS = ("body", "author")
INTEGER_FIELDS = {"score": "int", "created_utc": "bigint"}


def _field(name: str, optional: bool) -> Column:
    path = f"data.{name}"
    if name in INTEGER_FIELDS:
        return strict_integer("child", path, INTEGER_FIELDS[name])
    value = strict_text("child", path)
    return F.coalesce(value, F.lit("")) if optional else value


def read_children(
    listings: DataFrame, content_type: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``message`` (null where invalid) and ``raw`` JSON of every child of ``value``.

    A listing that cannot be read at all counts as one invalid child; an empty one as none.
    """
    post = content_type == "post"
    names = POST_FIELDS if post else COMMENT_FIELDS
    optional = () if post else OPTIONAL_COMMENT_FIELDS
    whole = F.col("value").cast("string")
    no_child = F.array(F.lit(None).cast("variant"))
    children = F.try_variant_get(F.col("document"), "$.data.children", "array<variant>")
    # The listing's text goes along with a child only where nothing could be read from it.
    exploded = (
        listings.select(*keep, whole.alias("value"))
        .withColumn("document", parse_json(F.col("value")))
        .select(*keep, "value", children.alias("children"))
        .withColumn("value", F.when(F.col("children").isNull(), F.col("value")))
        .select(*keep, "value", F.explode(F.coalesce("children", no_child)).alias("child"))
    )
    fields = exploded.select(
        *keep,
        F.coalesce("value", F.to_json("child")).alias("raw"),
        *[_field(name, name in optional).alias(name) for name in names],
    )
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    message = F.when(complete, F.struct(*names))
    return evaluate_once(fields, message=message).select(*keep, "raw", "message")


def flatten_listings(
    listings: DataFrame, content_type: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row of message fields per valid child, after the listing's own columns ``keep``."""
    children = read_children(listings, content_type, keep)
    return children.filter(F.col("message").isNotNull()).select(*keep, "message.*")


def listing_content(listings: DataFrame, content_type: str) -> DataFrame:
    """Valid children as unified content; their time is that of the listing."""
    text, parent = ("title", F.lit("")) if content_type == "post" else ("body", F.col("parent_id"))
    return flatten_listings(listings, content_type, keep=["timestamp"]).select(
        F.lit(None).cast("binary").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.lit(content_type).alias("content_type"),
        "id",
        F.col(text).alias("content"),
        parent.alias("parent_id"),
        "author",
        "subreddit",
        "score",
        "created_utc",
    )


def listing_failures(
    listings: DataFrame, content_type: str, config: PulseConfig = DEFAULTS
) -> DataFrame:
    """Invalid children, tagged like messages that failed to parse."""
    children = read_children(listings, content_type)
    return children.filter(F.col("message").isNull()).select(
        F.col("raw").alias("original_message"),
        F.lit(PARSE_ERROR).alias("error_type"),
        F.lit(f"Invalid {content_type.title()} Listing").alias("error_message"),
        F.lit(config.topic_for(content_type)).alias("source_topic"),
    )
