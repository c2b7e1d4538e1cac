"""Windows that close, over a stream that loses no row: late rows have a sink of their own.

A window closes when the watermark, the latest event time less the permitted delay, has passed
its end. Rows of open windows are landed as mergeable parts; rows of closed windows, and rows
without a time, go to the late sink. The watermark before and after each batch is written down
with the batch's part, so a replayed batch is divided as it was the first time. On-time rows and
late rows together are all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.operators.evaluation import (
    add_evaluation_parts,
    evaluation_parts,
    merged_evaluation,
)
from textpulse.operators.metrics import EXACT, add_parts, merged_metrics, metric_parts
from textpulse.sinks.parts import FANOUT, PartTable
from textpulse.sinks.tables import streaming_query_id
from textpulse.streaming.jobs import seconds_of

Sink = Callable[[DataFrame, int], None]
Frames = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class LiveWindows:
    """What a live job counts: parts of rows, their merge, and the finished windows."""

    path: str
    parts_of: Frames
    merge: Frames
    finish: Frames
    event_time: str
    length: str
    late_by: str
    fanout: int = FANOUT

    def table(self, spark: SparkSession) -> PartTable:
        return PartTable(spark, self.path, self.merge, fanout=self.fanout)

    def _closed(self, latest: int | None, window_end: Column) -> Column:
        """Whether a window is closed once ``latest`` has been seen; both in microseconds."""
        if latest is None:
            return F.lit(False)
        return window_end <= latest - round(seconds_of(self.late_by) * 1e6)

    def _window_end(self) -> Column:
        """The end of a row's window; Spark's own window would leave out rows without a time."""
        length = round(seconds_of(self.length) * 1e6)
        time = F.unix_micros(self.event_time)
        return time - F.pmod(time, F.lit(length)) + length

    def _note(self, table: PartTable, query_id: str, batch_id: int) -> tuple[int | None, bool]:
        """The latest event time before a batch, and whether the batch is a replay."""
        note = table.manifest().notes.get(query_id)
        if note is None:
            return None, False
        replayed = note["batch"] >= batch_id
        return note["before"] if replayed else note["after"], replayed

    def handle(self, batch: DataFrame, batch_id: int, late: Sink, changed: Sink | None) -> None:
        table, query_id = self.table(batch.sparkSession), streaming_query_id(batch)
        before, replayed = self._note(table, query_id, batch_id)
        closed = self._closed(before, self._window_end())
        is_late = F.col(self.event_time).isNull() | closed
        marked = batch.withColumn("_late", is_late)
        marked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late(marked.filter("_late").drop("_late"), batch_id)
            on_time = marked.filter("not _late").drop("_late")
            if not replayed:
                seen = on_time.agg(F.max(F.unix_micros(self.event_time))).first()[0]
                after = max((t for t in (before, seen) if t is not None), default=None)
                note = {"batch": batch_id, "before": before, "after": after}
                table.land(self.parts_of(on_time), batch_id, query_id, note)
            if changed is not None:
                touched = self.parts_of(on_time).select("window_start").distinct()
                rows = table.read()
                if rows is not None:
                    # As many windows as a batch touches.
                    some = rows.join(touched, "window_start", "left_semi")
                    changed(self.finish(some), batch_id)
        finally:
            marked.unpersist()

    def start(
        self,
        rows: DataFrame,
        checkpoint: str,
        late: Sink,
        changed: Sink | None = None,
        trigger: Mapping | None = None,
        name: str | None = None,
        config: PulseConfig = DEFAULTS,
    ) -> StreamingQuery:
        """Land the windows of a stream; ``changed`` gets the windows that a batch touched."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            self.handle(batch, batch_id, late, changed)

        writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        return writer.trigger(**(trigger or {"processingTime": config.metrics_every})).start()

    def windows(self, spark: SparkSession) -> DataFrame | None:
        """All windows as they stand; None before the first batch."""
        rows = self.table(spark).read()
        return None if rows is None else self.finish(rows)

    def closed_windows(self, spark: SparkSession) -> DataFrame | None:
        """The windows that will never change, of a table that one query writes."""
        windows = self.windows(spark)
        if windows is None:
            return None
        latest = [n["after"] for n in self.table(spark).manifest().notes.values()]
        known = [t for t in latest if t is not None]
        # With several queries, a window is closed when it is for each of them.
        lowest = min(known) if len(known) == len(latest) and known else None
        return windows.filter(self._closed(lowest, F.unix_micros("window_end")))


def live_metrics(
    path: str,
    event_time: str = "kafka_timestamp",
    length: str = "5 minutes",
    late_by: str = DEFAULTS.late_by,
    authors: str = EXACT,
) -> LiveWindows:
    """Windowed metrics of processed rows, exactly or with sketches of authors."""
    return LiveWindows(
        path,
        lambda rows: metric_parts(rows, event_time, length, authors),
        add_parts,
        merged_metrics,
        event_time,
        length,
        late_by,
    )


def live_evaluation(
    path: str,
    event_time: str = "kafka_timestamp",
    length: str = "5 minutes",
    late_by: str = DEFAULTS.late_by,
) -> LiveWindows:
    """Accuracy and confidence of predictions with labels, window by window."""
    return LiveWindows(
        path,
        lambda rows: evaluation_parts(rows, event_time, length),
        add_evaluation_parts,
        merged_evaluation,
        event_time,
        length,
        late_by,
    )


def join_labels(
    predictions: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    time: str = "kafka_timestamp",
    label_time: str = "label_timestamp",
    late_by: str = DEFAULTS.late_by,
    wait: str = "1 day",
) -> DataFrame:
    """Predictions with labels that come up to ``wait`` later; two streams, or two tables.

    On streams both sides have a watermark, so a prediction's state goes once its label can no
    longer come. A row that is later than ``late_by`` in its own stream is dropped by the join;
    ``rows_dropped`` counts these rows one by one.
    """
    renamed = labels.withColumnRenamed(key, "_label_key")
    if predictions.isStreaming:
        predictions = predictions.withWatermark(time, late_by)
        renamed = renamed.withWatermark(label_time, late_by)
    same = (F.col(key) == F.col("_label_key")) & F.col(label_time).between(
        F.col(time), F.col(time) + F.expr(f"interval {wait}")
    )
    return predictions.join(renamed, same).drop("_label_key", label_time)


def rows_dropped(query: StreamingQuery) -> int:
    """Rows that stateful steps of a query dropped as late, over its recent progress."""
    return sum(
        int(step["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for step in progress["stateOperators"]
    )
