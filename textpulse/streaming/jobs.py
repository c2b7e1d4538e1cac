"""The running queries: score, land, publish, watch and measure.

Each query has a checkpoint folder of its own. Scoring is a single query: it reads and
parses each message once and hands the batch to every sink, where one query per output
would read the bus again for each and risk sharing a checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.operators.dedup import KEYS, first_seen
from textpulse.operators.evaluation import windowed_evaluation
from textpulse.operators.metrics import (
    EXACT,
    add_parts,
    merged_metrics,
    metric_parts,
    processing_metrics,
    top_engaging,
    top_parts,
)
from textpulse.operators.model_store import ModelStore
from textpulse.operators.routing import dead_letters
from textpulse.operators.scoring import Scorer
from textpulse.plans.content import failures, processed_rows, route
from textpulse.sinks.messages import encode_dead_letters, encode_processed, publish
from textpulse.sinks.parts import FANOUT, GRACE, PartTable
from textpulse.sinks.tables import streaming_query_id
from textpulse.streaming.ledger import SinkLedger

Sink = Callable[[DataFrame, int], None]

# Drains what is there and stops; for backfills and tests.
ONCE: Mapping[str, object] = {"availableNow": True}


def every(interval: str) -> Mapping[str, object]:
    return {"processingTime": interval}


def _start(writer: DataStreamWriter, name: str | None, trigger: Mapping) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger).start()


def checkpoint_for(config: PulseConfig, name: str) -> str:
    if not config.checkpoint_root:
        raise ValueError("set checkpoint_root to a folder that all executors share")
    return f"{config.checkpoint_root}/{name}"


def start_scoring(
    envelopes: DataFrame,
    checkpoint: str,
    *,
    processed: Sequence[Sink] = (),
    dead: Sequence[Sink] = (),
    failed: Sequence[Sink] = (),
    config: PulseConfig = DEFAULTS,
    scorer: Scorer | None = None,
    now: Column | None = None,
    min_partitions: int | None = None,
    trigger: Mapping | None = None,
    name: str | None = None,
    ledger: str | None = None,
    models: ModelStore | None = None,
) -> StreamingQuery:
    """Score a stream of messages into sinks for processed rows and for dead letters.

    ``failed`` sinks get tagged failures before they become records, as previews need them.
    With a ``ledger``, a shared folder, every sink gets a batch by itself: one that fails does not
    hold up the others, and a replayed batch goes to the sinks that have not had it. Without one
    it reaches every sink again under its old id. Sinks are known by their place in the lists.

    With ``models``, each batch is scored by the model that is published when it begins, and its
    rows carry that version; ``scorer`` serves as long as none is published.
    A source with fewer partitions than ``min_partitions`` (few topic partitions or files)
    is spread before the costly steps.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if min_partitions and batch.rdd.getNumPartitions() < min_partitions:
            batch = batch.repartition(min_partitions)
        # Raw text is needed for failures only, so only those rows keep it.
        used, its_scorer = config, scorer
        version = models.current() if models is not None else None
        if version is not None:
            its_scorer = models.scorer(version)
            used = config.with_options(model_version=version)
        routed = route(batch, used, its_scorer).withColumn(
            "json_string", F.when(F.col("parsed").isNull(), F.col("json_string"))
        )
        routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            problems = failures(routed, used)
            outcomes = (
                ("processed", processed, processed_rows(routed, used, now)),
                ("failed", failed, problems),
                ("dead", dead, dead_letters(problems, now)),
            )
            deliveries = {
                f"{kind}-{n}": partial(sink, rows, batch_id)
                for kind, sinks, rows in outcomes
                for n, sink in enumerate(sinks)
            }
            if ledger is None:
                for deliver in deliveries.values():
                    deliver()
            else:
                book = SinkLedger(batch.sparkSession, ledger, streaming_query_id(batch))
                book.deliver(batch_id, deliveries)
        finally:
            routed.unpersist()

    writer = envelopes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or every(config.process_every))


def publish_processed(config: PulseConfig) -> Sink:
    """Processed rows as messages to their topic."""
    return lambda batch, _: publish(encode_processed(batch), config, config.processed_topic)


def publish_dead_letters(config: PulseConfig) -> Sink:
    """Dead-letter records as messages to their topic."""
    return lambda batch, _: publish(
        encode_dead_letters(batch), config, config.dead_letter_topic
    )


def show(preview: Callable[[DataFrame], DataFrame], rows: int = 20) -> Sink:
    """Print the first rows of a preview in full."""
    return lambda batch, _: preview(batch).show(rows, truncate=False)


_SECONDS = {
    "microsecond": 1e-6, "millisecond": 1e-3, "second": 1.0, "minute": 60.0, "hour": 3600.0,
    "day": 86400.0, "week": 604800.0,
}


def seconds_of(interval: str) -> float:
    """Seconds of an interval like "90 seconds" or "1 hour 30 minutes"."""
    parts = interval.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {interval!r}")
    total = 0.0
    for number, unit in zip(parts[::2], parts[1::2], strict=True):
        if unit.removesuffix("s") not in _SECONDS:
            raise ValueError(f"unknown unit {unit!r} in {interval!r}")
        total += float(number) * _SECONDS[unit.removesuffix("s")]
    return total


def at_most_every(interval: str, sink: Sink) -> Sink:
    """For previews: pass a batch on only if the last one was passed long enough ago."""
    seconds = seconds_of(interval)
    last = [float("-inf")]

    def limited(batch: DataFrame, batch_id: int) -> None:
        if time.monotonic() - last[0] >= seconds:
            last[0] = time.monotonic()
            sink(batch, batch_id)

    return limited


def start_console(
    preview: DataFrame, interval: str, rows: int = 20, name: str | None = None
) -> StreamingQuery:
    """A preview on the console as a query of its own."""
    writer = preview.writeStream.outputMode("append").format("console")
    writer = writer.option("truncate", False).option("numRows", rows)
    return _start(writer, name, every(interval))


def start_publishing(
    messages: DataFrame,
    checkpoint: str,
    config: PulseConfig,
    topic: str | None = None,
    trigger: Mapping | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Messages straight to the bus; without ``topic`` each row names its own."""
    writer = messages.writeStream.outputMode("append").format("kafka")
    writer = writer.option("kafka.bootstrap.servers", config.bootstrap_servers)
    if topic is not None:
        writer = writer.option("topic", topic)
    writer = writer.option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or every(config.process_every))


def start_landing(
    rows: DataFrame,
    checkpoint: str,
    sink: Sink,
    trigger: Mapping | None = None,
    name: str | None = None,
    config: PulseConfig = DEFAULTS,
) -> StreamingQuery:
    """Decoded records, batch by batch, into a sink that can take a batch twice."""
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or every(config.process_every))


def metric_table(
    spark: SparkSession, path: str, fanout: int = FANOUT, grace: float = GRACE
) -> PartTable:
    """The table of metric parts below a folder."""
    return PartTable(spark, path, add_parts, fanout=fanout, grace=grace)


def land_metrics(
    path: str,
    event_time: str = "kafka_timestamp",
    length: str = "5 minutes",
    authors: str = EXACT,
    fanout: int = FANOUT,
) -> Sink:
    """A sink of the parts that a batch adds to windowed metrics.

    No state is kept and no watermark drops anything: whenever a row arrives, it counts in
    its window when the parts are added up. Micro-batches may be of any size and order. Parts
    are merged as they become many; ``authors`` says how distinct authors are counted.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        table = metric_table(batch.sparkSession, path, fanout)
        table.sink(lambda rows: metric_parts(rows, event_time, length, authors))(batch, batch_id)

    return land


def start_metrics(
    processed: DataFrame,
    checkpoint: str,
    path: str,
    event_time: str = "kafka_timestamp",
    length: str = "5 minutes",
    trigger: Mapping | None = None,
    name: str | None = None,
    config: PulseConfig = DEFAULTS,
    authors: str = EXACT,
    fanout: int = FANOUT,
) -> StreamingQuery:
    """Land the metrics of every batch; ``latest_metrics`` reads the windows as they stand."""
    sink = land_metrics(path, event_time, length, authors, fanout)
    writer = processed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or every(config.metrics_every))


def _metric_rows(spark: SparkSession, path: str) -> DataFrame:
    rows = metric_table(spark, path).read()
    # Without a manifest it is a plain table of parts.
    return spark.read.parquet(path) if rows is None else rows


def latest_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of every window from all parts landed so far."""
    return merged_metrics(_metric_rows(spark, path))


def compact_metrics(spark: SparkSession, path: str, target: str) -> None:
    """All parts added up into one plain table of parts, as an export."""
    add_parts(_metric_rows(spark, path)).write.mode("overwrite").parquet(target)


def land_top(path: str, limit: int = 10, fanout: int = FANOUT) -> Sink:
    """A sink of the rows of each batch that may be among the most engaging ones."""

    def land(batch: DataFrame, batch_id: int) -> None:
        table = PartTable(
            batch.sparkSession, path, lambda parts: top_parts(parts, limit), fanout=fanout
        )
        table.sink(lambda rows: top_parts(rows, limit))(batch, batch_id)

    return land


def latest_top(
    spark: SparkSession, path: str, content_type: str, limit: int = 10
) -> DataFrame | None:
    """``top_engaging`` of all batches landed so far, up to the limit they were landed with."""
    rows = PartTable(spark, path, top_parts).read()
    return None if rows is None else top_engaging(rows, content_type, limit)


def first_seen_table(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = KEYS,
    arrival: str = "kafka_timestamp",
    fanout: int = FANOUT,
) -> PartTable:
    """The table of first copies below a folder; the merge of parts drops later ones."""
    return PartTable(spark, path, lambda rows: first_seen(rows, keys, arrival), fanout=fanout)


def land_first_seen(
    path: str,
    keys: Sequence[str] = KEYS,
    arrival: str = "kafka_timestamp",
    fanout: int = FANOUT,
) -> Sink:
    """A sink that lands the first copy of every key, whatever the order of batches.

    A batch lands its own first copies and looks up nothing. Copies that batches have in common
    meet when their parts are merged, so a row is read once a level, which is as often as the
    logarithm of the batches, and ``first_rows`` settles the few parts that are left.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        table = first_seen_table(batch.sparkSession, path, keys, arrival, fanout)
        table.sink(lambda rows: first_seen(rows, keys, arrival))(batch, batch_id)

    return land


def first_rows(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = KEYS,
    arrival: str = "kafka_timestamp",
) -> DataFrame | None:
    """The first copy of every key landed so far; None before the first batch."""
    rows = first_seen_table(spark, path, keys, arrival).read()
    return None if rows is None else first_seen(rows, keys, arrival)


def streaming_metrics(
    processed: DataFrame,
    event_time: str = "kafka_timestamp",
    length: str = "5 minutes",
    late_by: str = DEFAULTS.late_by,
) -> DataFrame:
    """A live view with bounded state: authors approximately, late rows left out.

    Rows later than ``late_by`` are counted by ``start_metrics``, and go to a sink of their own in
    ``live.live_metrics``.
    """
    return processing_metrics(
        processed.withWatermark(event_time, late_by), event_time, length, approximate=True
    )


def start_evaluation(
    predictions: DataFrame,
    checkpoint: str,
    sink: Sink,
    late_by: str = DEFAULTS.late_by,
    length: str = "5 minutes",
    trigger: Mapping | None = None,
    name: str | None = None,
    config: PulseConfig = DEFAULTS,
) -> StreamingQuery:
    """Accuracy of a stream of predictions, window by window; changed windows each batch.

    Rows later than ``late_by`` are left out; ``live.live_evaluation`` hands them to a sink.
    """
    evaluated = windowed_evaluation(predictions, length=length, late_by=late_by)
    writer = evaluated.writeStream.outputMode("update").foreachBatch(sink)
    writer = writer.option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or every(config.metrics_every))
