"""The applications on a real bus: ingest listings, score messages, land results, measure.

Each returns its running queries; the caller waits for them (``awaitAnyTermination``).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.config import PulseConfig
from textpulse.operators.dedup import first_seen_stream
from textpulse.operators.first_copies import SUPERSEDES, first_copies
from textpulse.operators.model_store import ModelStore
from textpulse.operators.scoring import Scorer
from textpulse.schemas import DEAD_LETTER, PROCESSED
from textpulse.sinks.messages import (
    dead_letter_preview,
    encode_dead_letters,
    encode_raw,
    result_preview,
)
from textpulse.sinks.tables import land_in_database, land_in_directory, target_from_config
from textpulse.sources import bus
from textpulse.sources.listings import listing_content
from textpulse.sources.records import decode_dead_letters, decode_processed
from textpulse.streaming import jobs
from textpulse.streaming.live import join_labels, live_evaluation


def ingest(
    post_listings: DataFrame, comment_listings: DataFrame, config: PulseConfig
) -> jobs.StreamingQuery:
    """New posts and comments of streamed API listings, each once, to their topics.

    Of several copies the first one goes out. An id is remembered for ever, unless the settings
    say for how long; a copy that turns out to be earlier than what went out stays behind.
    """
    content = listing_content(post_listings, "post").unionByName(
        listing_content(comment_listings, "comment")
    )
    if config.remember_ids_for is None:
        unique = first_copies(content).filter(~F.col(SUPERSEDES))
    else:
        unique = first_seen_stream(content, config.remember_ids_for)
    return jobs.start_publishing(
        encode_raw(unique, config),
        jobs.checkpoint_for(config, "ingest"),
        config,
        name="ingest",
    )


def score(
    spark: SparkSession,
    config: PulseConfig,
    scorer: Scorer | None = None,
    min_partitions: int | None = None,
    models: ModelStore | None = None,
) -> jobs.StreamingQuery:
    """Messages of both topics to processed records, dead letters and console previews.

    Every sink gets each batch by itself. With ``dead_letter_staging`` set, dead letters wait there
    for ``report_dead_letters``; otherwise they go out with the batch.
    """
    if config.dead_letter_staging:
        dead_sink = land_in_directory(config.dead_letter_staging)
    else:
        dead_sink = jobs.publish_dead_letters(config)
    envelopes = bus.posts_stream(spark, config).unionByName(bus.comments_stream(spark, config))
    return jobs.start_scoring(
        envelopes,
        jobs.checkpoint_for(config, "score"),
        processed=[
            jobs.publish_processed(config),
            jobs.at_most_every(config.preview_every, jobs.show(result_preview)),
        ],
        dead=[dead_sink],
        failed=[
            jobs.at_most_every(config.dead_letter_log_every, jobs.show(dead_letter_preview))
        ],
        config=config,
        scorer=scorer,
        min_partitions=min_partitions,
        name="score",
        ledger=f"{config.checkpoint_root}/score-ledger",
        models=models,
    )


def report_dead_letters(spark: SparkSession, config: PulseConfig) -> jobs.StreamingQuery:
    """Dead letters that wait in their folder to their topic, at their own pace."""
    if not config.dead_letter_staging:
        raise ValueError("set dead_letter_staging to the folder that score lands in")
    folders = f"{config.dead_letter_staging}/query_id=*/batch_id=*"
    return jobs.start_publishing(
        encode_dead_letters(spark.readStream.schema(DEAD_LETTER).parquet(folders)),
        jobs.checkpoint_for(config, "report_dead_letters"),
        config,
        config.dead_letter_topic,
        jobs.every(config.dead_letter_every),
        name="report_dead_letters",
    )


def evaluate(
    predictions: DataFrame,
    labels: DataFrame,
    config: PulseConfig,
    path: str,
    late: jobs.Sink,
    changed: jobs.Sink | None = None,
) -> jobs.StreamingQuery:
    """Accuracy by window of predictions whose labels come later; both are streams."""
    live = live_evaluation(path, late_by=config.late_by)
    return live.start(
        join_labels(predictions, labels, late_by=config.late_by),
        jobs.checkpoint_for(config, "evaluate"),
        late,
        changed,
        jobs.every(config.metrics_every),
        name="evaluate",
    )


def land(
    spark: SparkSession, config: PulseConfig, connect: Callable[[], Any], **jdbc_options: str
) -> list[jobs.StreamingQuery]:
    """Processed records and dead letters to their relational tables."""
    dead_columns = (*DEAD_LETTER.fieldNames(), "error_timestamp")
    plans = (
        (
            "land_processed",
            decode_processed(bus.processed_stream(spark, config)),
            config.process_every,
            config.processed_table,
            tuple(PROCESSED.fieldNames()),
        ),
        (
            "land_dead_letters",
            decode_dead_letters(bus.dead_letter_stream(spark, config)),
            config.dead_letter_every,
            config.dead_letter_table,
            dead_columns,
        ),
    )
    return [
        jobs.start_landing(
            rows,
            jobs.checkpoint_for(config, name),
            land_in_database(
                target_from_config(config, name, table, columns, connect, **jdbc_options)
            ),
            jobs.every(interval),
            name=name,
            config=config,
        )
        for name, rows, interval, table, columns in plans
    ]


def measure(spark: SparkSession, config: PulseConfig, path: str) -> jobs.StreamingQuery:
    """Windowed metrics of the processed records, in parts for ``latest_metrics``."""
    processed = decode_processed(bus.processed_stream(spark, config))
    return jobs.start_metrics(
        processed,
        jobs.checkpoint_for(config, "measure"),
        path,
        "processing_timestamp",
        name="measure",
        config=config,
    )
