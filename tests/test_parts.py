"""Part tables: few parts, readers and writers at work, replays; sketches and top rows."""

import math
import threading

import pytest
from pyspark.sql import functions as F

from tests.support import SMALL, compare
from textpulse.operators.metrics import (
    EXACT,
    SKETCH,
    SKETCH_SIZE,
    add_parts,
    merged_metrics,
    metric_parts,
    processing_metrics,
    top_engaging,
    top_parts,
)
from textpulse.sinks.folders import SharedFolder
from textpulse.sinks.parts import PartTable
from textpulse.sources import tables as tb
from textpulse.streaming import jobs


def sums(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def table(spark, path, **options):
    return PartTable(spark, str(path), sums, **{"fanout": 3, "grace": 0.0, **options})


def part(spark, batch):
    return spark.createDataFrame([(batch % 4, 1), (9, batch)], "k long, n long").coalesce(1)


def totals(rows):
    return {r.k: r.n for r in sums(rows).collect()}


def test_a_new_file_never_replaces_another(spark, tmp_path):
    folder = SharedFolder(spark, str(tmp_path / "f"))
    assert folder.names() == [] and folder.read("a") is None
    assert folder.put_new("a", "é1")
    assert not folder.put_new("a", "2")
    assert folder.read("a") == "é1" and folder.names() == ["a"]
    folder.delete("a")
    folder.delete("a")
    assert folder.names() == []


def test_parts_stay_logarithmic_and_sums_right(spark, tmp_path):
    parts = table(spark, tmp_path / "t")
    assert parts.read() is None
    expected = {}
    for batch in range(40):
        assert parts.land(part(spark, batch), batch, "q")
        for k, n in ((batch % 4, 1), (9, batch)):
            expected[k] = expected.get(k, 0) + n
        held = parts.manifest().parts
        levels = math.ceil(math.log(batch + 2, 3)) + 1
        assert len(held) <= 2 * levels and max(held.values()) <= levels
    assert totals(parts.read()) == expected
    # Merged parts are gone from the folder as well, and old manifests.
    held = SharedFolder(spark, f"{tmp_path}/t/query_id=q").names()
    assert {f"query_id=q/{name}" for name in held} == {
        name for name, level in parts.manifest().parts.items() if not level
    }
    assert len(SharedFolder(spark, f"{tmp_path}/t/_manifest").names()) <= 20


def test_replayed_batches_count_once(spark, tmp_path):
    parts = table(spark, tmp_path / "t")
    for batch in (0, 1, 1, 2, 3, 3, 2):
        parts.land(part(spark, batch), batch, "q")
    # A query with a new checkpoint counts its batches from 0 again.
    parts.land(part(spark, 0), 0, "other")
    assert totals(parts.read()) == {0: 2, 1: 1, 2: 1, 3: 1, 9: 6}


def test_an_attempt_that_broke_off_is_no_part(spark, tmp_path):
    parts = table(spark, tmp_path / "t")
    parts.land(part(spark, 0), 0, "q")
    part(spark, 7).write.parquet(f"{tmp_path}/t/query_id=q/batch_id=1")
    assert totals(parts.read()) == {0: 1, 9: 0}
    parts.land(part(spark, 1), 1, "q")
    assert totals(parts.read()) == {0: 1, 1: 1, 9: 1}


def test_readers_keep_what_they_have_begun_to_read(spark, tmp_path):
    parts = table(spark, tmp_path / "t", grace=3600.0)
    for batch in range(2):
        parts.land(part(spark, batch), batch, "q")
    reader = parts.read()
    for batch in range(2, 9):
        parts.land(part(spark, batch), batch, "q")
    assert totals(reader) == {0: 1, 1: 1, 9: 1}


def test_two_writers_at_once(spark, tmp_path):
    failed = []

    def write(query):
        try:
            parts = table(spark, tmp_path / "t", grace=3600.0)
            for batch in range(8):
                parts.land(part(spark, batch), batch, query)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    writers = [threading.Thread(target=write, args=(f"q{n}",)) for n in range(3)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert not failed
    parts = table(spark, tmp_path / "t")
    assert totals(parts.read()) == {0: 6, 1: 6, 2: 6, 3: 6, 9: 84}
    assert parts.manifest().batches == {"q0": 7, "q1": 7, "q2": 7}


@pytest.fixture(scope="module")
def records(spark):
    return tb.event_records(tb.read_table(spark, SMALL, "events")).cache()


def batches_of(records, count):
    return [records.filter(F.pmod(F.xxhash64("id"), F.lit(count)) == n) for n in range(count)]


def test_metrics_of_many_batches(spark, records, tmp_path):
    parts = PartTable(spark, str(tmp_path / "t"), add_parts, fanout=3)
    for batch, rows in enumerate(batches_of(records, 10)):
        parts.land(metric_parts(rows), batch, "q")
    assert len(parts.manifest().parts) <= 5
    got = jobs.latest_metrics(spark, str(tmp_path / "t"))
    assert compare(got.toPandas(), processing_metrics(records).toPandas()) is None


def test_sketches_count_authors_within_their_error(spark, tmp_path):
    rows = spark.range(60000).select(
        F.lit("post").alias("content_type"),
        F.when(F.col("id") % 3 == 0, "big").otherwise("small").alias("subreddit"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("a"), F.col("id")))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("b"), F.col("id") % 500))
        .alias("author"),
        F.lit("positive").alias("sentiment"),
        F.lit(0.5).alias("sentiment_score"),
        F.lit(0.5).alias("confidence"),
        F.lit(1).alias("engagement_score"),
        F.lit(10).alias("text_length"),
        F.timestamp_seconds(F.col("id") % 600).alias("processing_timestamp"),
        F.col("id").cast("string").alias("id"),
    )
    parts = PartTable(spark, str(tmp_path / "t"), add_parts, fanout=2)
    for batch, some in enumerate(batches_of(rows, 5)):
        made = metric_parts(some, authors=SKETCH)
        # A part a window and group, whatever the authors.
        assert made.count() == 4
        parts.land(made, batch, "q")
    exact = {
        (r.window_start, r.subreddit): r for r in processing_metrics(rows).collect()
    }
    error = 3 * 1.04 / math.sqrt(2**SKETCH_SIZE)
    found = merged_metrics(parts.read()).collect()
    assert len(found) == len(exact) == 4
    for row in found:
        true = exact[row.window_start, row.subreddit]
        assert abs(row.unique_authors - true.unique_authors) <= error * true.unique_authors + 1
        assert row.total_processed == true.total_processed


def test_sketches_of_rows_without_authors(spark, records):
    rows = records.withColumn("author", F.lit(None).cast("string"))
    for authors in (EXACT, SKETCH):
        got = merged_metrics(metric_parts(rows, authors=authors)).toPandas()
        assert compare(got, processing_metrics(rows).toPandas()) is None
    with pytest.raises(ValueError):
        metric_parts(rows, authors="roughly")


@pytest.mark.parametrize("backwards", [False, True])
def test_top_rows_from_parts_in_any_order(spark, records, tmp_path, backwards):
    rows = records.select(
        "*", F.concat(F.lit("t"), F.col("id")).alias("content")
    ).withColumn("engagement_score", (F.col("engagement_score") % 7).cast("int"))
    batches = batches_of(rows, 7)
    merge = lambda parts: top_parts(parts, 10)
    parts = PartTable(spark, str(tmp_path / "t"), merge, fanout=2)
    for batch, some in enumerate(reversed(batches) if backwards else batches):
        parts.land(top_parts(some, 10), batch, "q")
    assert parts.read().count() <= 20 * len(parts.manifest().parts)
    for kind in ("post", "comment"):
        got = jobs.latest_top(spark, str(tmp_path / "t"), kind).toPandas()
        assert compare(got, top_engaging(rows, kind).toPandas()) is None
    assert jobs.latest_top(spark, str(tmp_path / "none"), "post") is None
