"""Streams over directories: equal to the batch, restartable, replay-safe."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.support import SMALL, compare, rows
from textpulse.catalog.queries import fixed_now
from textpulse.config import PulseConfig
from textpulse.operators.dedup import first_seen, first_seen_stream, keep_first_seen
from textpulse.operators.evaluation import windowed_evaluation
from textpulse.operators.metrics import processing_metrics
from textpulse.operators.routing import dead_letters, parse_messages, valid_content
from textpulse.plans.content import failures, processed_rows, route
from textpulse.sinks.messages import dead_letter_preview, encode_processed, result_preview
from textpulse.sinks.tables import BATCH_COLUMNS, land_in_directory
from textpulse.sources import bus
from textpulse.sources import tables as tb
from textpulse.sources.listings import flatten_listings
from textpulse.sources.records import decode_processed
from textpulse.streaming import jobs


@pytest.fixture(scope="module")
def posts(spark):
    envelopes = tb.post_envelopes(tb.read_table(spark, SMALL, "documents"))
    return envelopes.drop("content_type").cache()


def write(df, path, part):
    df.repartition(2).write.parquet(f"{path}/part={part}")


def source(spark, path, kind="post", cap=1):
    return bus.directory_stream(spark, f"{path}/part=*", kind, max_files_per_trigger=cap)


def score(spark, path, root, previews=None):
    query = jobs.start_scoring(
        source(spark, path),
        f"{root}/checkpoint",
        processed=[land_in_directory(f"{root}/processed"), *(previews or [])],
        dead=[land_in_directory(f"{root}/dead")],
        now=fixed_now(),
        min_partitions=2,
        trigger=jobs.ONCE,
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_over_a_restart(spark, posts, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    halves = posts.randomSplit([0.5, 0.5], seed=3)
    write(halves[0], path, 0)
    score(spark, path, root)
    first = spark.read.parquet(f"{root}/processed").count()
    score(spark, path, root)
    assert spark.read.parquet(f"{root}/processed").count() == first
    write(halves[1], path, 1)
    score(spark, path, root)

    routed = route(posts.withColumn("content_type", F.lit("post")))
    landed = spark.read.parquet(f"{root}/processed")
    assert landed.select("batch_id").distinct().count() >= 3
    expected = processed_rows(routed, now=fixed_now())
    assert compare(landed.drop(*BATCH_COLUMNS).toPandas(), expected.toPandas()) is None
    dead = spark.read.parquet(f"{root}/dead").drop(*BATCH_COLUMNS)
    assert rows(dead.toPandas()) == rows(dead_letters(failures(routed), fixed_now()).toPandas())


def test_previews_print_in_full(spark, posts, tmp_path, capfd):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    write(posts, path, 0)
    score(spark, path, root, [jobs.show(result_preview)])
    assert "content_preview" in capfd.readouterr().out


def test_console_queries_run(spark, posts, tmp_path):
    path = str(tmp_path / "in")
    write(posts, path, 0)
    failed = failures(route(source(spark, path, cap=None)))
    query = jobs.start_console(dead_letter_preview(failed), "1 second", name="dead_letter_log")
    query.processAllAvailable()
    assert query.lastProgress["numInputRows"] >= 0 and query.exception() is None
    query.stop()


def test_landing_decoded_records(spark, posts, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    processed = processed_rows(route(posts.withColumn("content_type", F.lit("post"))), now=fixed_now())
    messages = encode_processed(processed).select(
        F.encode("key", "utf-8").alias("key"),
        F.encode("value", "utf-8").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
    write(messages, path, 0)
    stream = decode_processed(bus.as_text(source(spark, path, kind=None)))
    jobs.start_landing(
        stream, f"{root}/checkpoint", land_in_directory(f"{root}/table"), jobs.ONCE
    ).awaitTermination()
    landed = spark.read.parquet(f"{root}/table").drop(*BATCH_COLUMNS)
    expected = decode_processed(bus.as_text(messages))
    assert compare(landed.toPandas(), expected.toPandas()) is None


def test_listings_to_first_seen_messages(spark, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    listings = tb.post_listings(tb.read_table(spark, SMALL, "documents")).select(
        F.lit(None).cast("binary").alias("key"), F.encode("value", "utf-8").alias("value"), "timestamp"
    )
    write(listings, path, 0)
    write(listings.limit(50), path, 1)
    stream = flatten_listings(source(spark, path, cap=None), "post", keep=["content_type", "timestamp"])
    unique = first_seen_stream(stream, "10 minutes", arrival="timestamp")
    jobs.start_landing(
        unique, f"{root}/checkpoint", land_in_directory(f"{root}/table"), jobs.ONCE
    ).awaitTermination()
    expected = flatten_listings(listings, "post").select("id").distinct()
    landed = spark.read.parquet(f"{root}/table").select("id")
    assert rows(landed.toPandas()) == rows(expected.toPandas())


@pytest.mark.parametrize("remember_for", ["30 days", None])
def test_duplicates_across_batches_are_dropped(spark, posts, tmp_path, remember_for):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (0, 1):
        write(posts, path, part)
    content = valid_content(parse_messages(source(spark, path, cap=2)))
    unique = first_seen_stream(content, remember_for)
    jobs.start_landing(
        unique, f"{root}/checkpoint", land_in_directory(f"{root}/table"), jobs.ONCE
    ).awaitTermination()
    ids = spark.read.parquet(f"{root}/table").groupBy("id").count()
    assert ids.filter("count > 1").count() == 0
    assert ids.count() == valid_content(
        parse_messages(posts.withColumn("content_type", F.lit("post")))
    ).select("id").distinct().count()


def newest_first(posts, path):
    """Four files, one a trigger, the newest rows first."""
    ordered = posts.withColumn("part", F.ntile(4).over(Window.orderBy(F.desc("timestamp"))))
    for part in range(1, 5):
        write(ordered.filter(F.col("part") == part).drop("part"), path, part)


def test_metrics_count_rows_in_any_order(spark, posts, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    newest_first(posts, path)
    processed = processed_rows(route(source(spark, path)), now=fixed_now())
    jobs.start_metrics(
        processed, f"{root}/checkpoint", f"{root}/parts", trigger=jobs.ONCE
    ).awaitTermination()
    parts = spark.read.parquet(f"{root}/parts")
    assert parts.select("batch_id").distinct().count() >= 4
    batch = processing_metrics(
        processed_rows(route(posts.withColumn("content_type", F.lit("post"))), now=fixed_now()),
        "kafka_timestamp",
    )
    got = jobs.latest_metrics(spark, f"{root}/parts")
    assert compare(got.toPandas(), batch.toPandas()) is None
    jobs.compact_metrics(spark, f"{root}/parts", f"{root}/compact")
    assert compare(jobs.latest_metrics(spark, f"{root}/compact").toPandas(), batch.toPandas()) is None


def test_first_rows_are_kept_in_any_order(spark, posts, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    newest_first(posts, path)
    content = valid_content(parse_messages(source(spark, path)))
    twice = tb.repeated(content, F.col("id").cast("bigint"))
    for _ in range(2):
        jobs.start_landing(
            twice, f"{root}/checkpoint", keep_first_seen(f"{root}/first"), jobs.ONCE
        ).awaitTermination()
    landed = spark.read.parquet(f"{root}/first")
    assert landed.select("batch_id").distinct().count() >= 4
    whole = valid_content(parse_messages(posts.withColumn("content_type", F.lit("post"))))
    expected = first_seen(tb.repeated(whole, F.col("id").cast("bigint")))
    assert compare(landed.drop(*BATCH_COLUMNS).toPandas(), expected.toPandas()) is None


def test_copies_in_later_batches_are_not_first(spark, posts, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (0, 1):
        write(posts, path, part)
    content = valid_content(parse_messages(source(spark, path, cap=2)))
    jobs.start_landing(
        content, f"{root}/checkpoint", keep_first_seen(f"{root}/first"), jobs.ONCE
    ).awaitTermination()
    ids = spark.read.parquet(f"{root}/first").groupBy("id").count()
    assert ids.filter("count > 1").count() == 0 and ids.count() > 0


def test_live_view_counts_authors_roughly(spark, posts, tmp_path):
    path = str(tmp_path / "in")
    write(posts, path, 0)
    processed = processed_rows(route(source(spark, path)), now=fixed_now())
    view = jobs.streaming_metrics(processed, late_by="30 days")
    assert view.isStreaming and "unique_authors" in view.columns


def test_evaluation_of_a_stream(spark, tmp_path):
    path, landed = str(tmp_path / "in"), {}
    rows_ = [(float(n % 3), float(n % 2), 0.5, 60 * n) for n in range(40)]
    table = spark.createDataFrame(rows_, "label double, prediction double, confidence double, s long")
    table = table.select("*", F.timestamp_seconds("s").alias("kafka_timestamp")).drop("s")
    write(table, path, 0)
    stream = spark.readStream.schema(table.schema).parquet(f"{path}/part=*")

    def keep(batch, _):
        landed.update({r.window_start: r for r in batch.collect()})

    jobs.start_evaluation(
        stream, str(tmp_path / "c"), keep, late_by="10 minutes", trigger=jobs.ONCE
    ).awaitTermination()
    expected = windowed_evaluation(table).collect()
    assert sorted(landed.values()) == sorted(expected)


@pytest.mark.parametrize(
    "interval, seconds",
    [("2 hours", 7200), ("500 milliseconds", 0.5), ("1 minute", 60), ("1 day", 86400),
     ("1 hour 30 minutes", 5400), ("interval 10 seconds", 10)],
)
def test_intervals(interval, seconds):
    assert jobs.seconds_of(interval) == seconds


@pytest.mark.parametrize("interval", ["", "5", "3 fortnights", "x seconds"])
def test_unknown_intervals(interval):
    with pytest.raises(ValueError):
        jobs.seconds_of(interval)


def test_checkpoints_are_named_per_query():
    config = PulseConfig(checkpoint_root="/shared")
    assert jobs.checkpoint_for(config, "scoring") == "/shared/scoring"
    with pytest.raises(ValueError):
        jobs.checkpoint_for(PulseConfig(), "scoring")
