"""Aggregates over processed content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTIMENTS = ("positive", "negative", "neutral")


def _count_of(sentiment: str) -> Column:
    # Null sentiments count for none of the classes, and an empty sum is 0.
    return F.count_if(F.col("sentiment") == sentiment)


def units(value: Column) -> Column:
    """A number in millionths, whole: sums of these do not depend on the order of rows."""
    return F.round(value * 1e6).cast("bigint")


def quotient(total: Column, count: Column) -> Column:
    """Total millionths over a count, to the nearest millionth, halves up."""
    doubled = F.call_function("div", 2 * total + count, 2 * count)
    return F.when(count > 0, doubled / 1e6)


def mean(name: str) -> Column:
    """The average to six digits, the same however rows are partitioned."""
    return quotient(F.sum(units(F.col(name))), F.count(name))


def tumbling(df: DataFrame, time: str, length: str, *keys: str):
    """Group by time window and keys, with the window bounds as two columns."""
    span = F.window(F.col(time), length)
    return df.groupBy(span.alias("window"), *keys)


def flatten_window(df: DataFrame) -> DataFrame:
    rest = [name for name in df.columns if name != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def processing_metrics(
    df: DataFrame,
    time: str = "processing_timestamp",
    length: str = "5 minutes",
    *,
    approximate: bool = False,
) -> DataFrame:
    """Volume, averages, class counts and authors per window, content type and subreddit.

    Exact author counts aggregate per author before they aggregate per group, so a group or
    author with a large share of the rows is reduced map-side. Streams cannot count exactly
    and take ``approximate``.
    """
    authors = F.approx_count_distinct("author") if approximate else F.count_distinct("author")
    grouped = tumbling(df, time, length, "content_type", "subreddit").agg(
        F.count(F.lit(1)).alias("total_processed"),
        mean("sentiment_score").alias("avg_sentiment"),
        mean("confidence").alias("avg_confidence"),
        *[_count_of(name).alias(f"{name}_count") for name in SENTIMENTS],
        F.max("engagement_score").alias("max_engagement"),
        mean("text_length").alias("avg_text_length"),
        authors.alias("unique_authors"),
    )
    return flatten_window(grouped)


_AVERAGED = {"avg_sentiment": "sentiment_score", "avg_confidence": "confidence",
             "avg_text_length": "text_length"}
_WINDOW_KEYS = ("window_start", "window_end", "content_type", "subreddit")


# How streams count distinct authors: exactly, with a part for each author, or in sketches.
EXACT, SKETCH = "exact", "sketch"
# Two to this power are the counters of a sketch; 2 % is the usual error at 12.
SKETCH_SIZE = 12


def metric_parts(
    df: DataFrame,
    time: str = "processing_timestamp",
    length: str = "5 minutes",
    authors: str = EXACT,
) -> DataFrame:
    """What some rows add to ``processing_metrics``, to be added up later.

    Exact author counts need a part for each author of a window. With sketches there is one
    part a window, whatever the authors, and counts are approximate.
    """
    if authors not in (EXACT, SKETCH):
        raise ValueError(f"authors are counted {EXACT!r} or {SKETCH!r}, not {authors!r}")
    sums = {
        f"{name}_{part}": value
        for name, column in _AVERAGED.items()
        for part, value in (("sum", F.sum(units(F.col(column)))), ("n", F.count(column)))
    }
    keys = ["content_type", "subreddit", *(["author"] if authors == EXACT else [])]
    sketch = [F.hll_sketch_agg("author", F.lit(SKETCH_SIZE)).alias(_SKETCH)]
    grouped = tumbling(df, time, length, *keys).agg(
        F.count(F.lit(1)).alias("total_processed"),
        *[_count_of(name).alias(f"{name}_count") for name in SENTIMENTS],
        F.max("engagement_score").alias("max_engagement"),
        *[value.alias(name) for name, value in sums.items()],
        *(sketch if authors == SKETCH else []),
    )
    return flatten_window(grouped)


_SKETCH = "authors_sketch"


def add_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Parts of the same keys as one; per window and author unless other keys are given."""
    sketched = _SKETCH in parts.columns
    keys = keys or (*_WINDOW_KEYS, *(() if sketched else ("author",)))
    added = [
        "total_processed",
        *[f"{name}_count" for name in SENTIMENTS],
        *[f"{name}_{part}" for name in _AVERAGED for part in ("sum", "n")],
    ]
    sketch = [F.hll_union_agg(_SKETCH).alias(_SKETCH)] if sketched else []
    return parts.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in added],
        F.max("max_engagement").alias("max_engagement"),
        *sketch,
    )


def _finished(total: DataFrame, unique_authors: Column) -> DataFrame:
    """The metrics of windows whose parts are added up."""
    averages = {
        name: quotient(F.col(f"{name}_sum"), F.col(f"{name}_n")).alias(name) for name in _AVERAGED
    }
    return total.select(
        *_WINDOW_KEYS,
        "total_processed",
        averages["avg_sentiment"],
        averages["avg_confidence"],
        *[f"{name}_count" for name in SENTIMENTS],
        "max_engagement",
        averages["avg_text_length"],
        unique_authors.alias("unique_authors"),
    )


def merged_metrics(parts: DataFrame) -> DataFrame:
    """``processing_metrics`` from parts.

    Parts by author aggregate by author first, so that authors are counted exactly; sketches
    are united and estimated.
    """
    if _SKETCH in parts.columns:
        return _finished(add_parts(parts), F.hll_sketch_estimate(_SKETCH))
    by_author = add_parts(parts)
    # An author is one row here, so both steps reduce on the map side and nothing is joined.
    known = by_author.withColumn("_known", F.col("author").isNotNull().cast("bigint"))
    authors = F.sum("_known").alias("_authors")
    added = [name for name in by_author.columns if name not in (*_WINDOW_KEYS, "author")]
    total = known.groupBy(*_WINDOW_KEYS).agg(
        *[F.sum(name).alias(name) for name in added if name != "max_engagement"],
        F.max("max_engagement").alias("max_engagement"),
        authors,
    )
    return _finished(total, F.col("_authors"))


def sentiment_by_group(df: DataFrame) -> DataFrame:
    """Class counts and their shares per subreddit and content type."""
    grouped = df.groupBy("subreddit", "content_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        mean("sentiment_score").alias("avg_sentiment_score"),
        *[_count_of(name).alias(name) for name in SENTIMENTS],
    )
    shares = {
        f"{name}_ratio": quotient(F.col(name) * 1_000_000, F.col("total_count"))
        for name in SENTIMENTS
    }
    return grouped.withColumns(shares)


def top_engaging(df: DataFrame, content_type: str, limit: int = 10) -> DataFrame:
    """The rows of one type with most engagement; ties go by id and then by content.

    Each partition keeps ``limit`` rows, and only those are merged.
    """
    return (
        df.filter(F.col("content_type") == content_type)
        .orderBy(F.desc("engagement_score"), "id", "content")
        .select("id", "content", "subreddit", "sentiment", "engagement_score", "author")
        .limit(limit)
    )


_TOP_COLUMNS = ("id", "content", "subreddit", "sentiment", "engagement_score", "author")


def top_parts(
    df: DataFrame, limit: int = 10, content_types: Sequence[str] = ("post", "comment")
) -> DataFrame:
    """The rows of each type that may be among the top ones, ``limit`` a type, to be merged.

    Rows that some rows do not have among their top ones are not among those of more rows
    either, so the same step merges parts, in any order, and the result is exact.
    """
    parts = [
        df.filter(F.col("content_type") == kind)
        .orderBy(F.desc("engagement_score"), "id", "content")
        .select("content_type", *_TOP_COLUMNS)
        .limit(limit)
        for kind in content_types
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
