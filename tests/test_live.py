"""Live windows: on time and late are all, closed windows stay, labels that come later."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.support import compare
from textpulse.config import PulseConfig
from textpulse.operators.evaluation import windowed_evaluation
from textpulse.operators.metrics import processing_metrics
from textpulse.sinks.tables import land_in_directory
from textpulse.streaming import apps, jobs
from textpulse.streaming.live import join_labels, live_evaluation, live_metrics, rows_dropped

SCHEMA = (
    "id string, content_type string, subreddit string, author string, sentiment string, "
    "sentiment_score double, confidence double, engagement_score int, text_length int, "
    "label double, prediction double, kafka_timestamp timestamp"
)


@pytest.fixture(scope="module")
def records(spark):
    n = F.col("id")
    return spark.range(400).select(
        n.cast("string").alias("id"),
        F.when(n % 2 == 0, "post").otherwise("comment").alias("content_type"),
        F.lit("s").alias("subreddit"),
        F.concat(F.lit("a"), n % 17).alias("author"),
        F.when(n % 3 == 0, "positive").otherwise("negative").alias("sentiment"),
        (n % 5 / 5).alias("sentiment_score"),
        (n % 8 / 8).alias("confidence"),
        (n % 31).cast("int").alias("engagement_score"),
        (n % 50).cast("int").alias("text_length"),
        (n % 3).cast("double").alias("label"),
        (n % 2).cast("double").alias("prediction"),
        F.when(n % 100 != 99, F.timestamp_seconds(n * 20)).alias("kafka_timestamp"),
    ).cache()


def write(records, path, newest_first):
    order = F.desc("kafka_timestamp") if newest_first else F.asc("kafka_timestamp")
    parts = records.withColumn("part", F.ntile(4).over(Window.orderBy(order)))
    for part in range(1, 5):
        parts.filter(F.col("part") == part).drop("part").coalesce(1).write.parquet(f"{path}/part={part}")


def run(spark, live, path, root, changed=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/part=*")
    query = live.start(
        stream, f"{root}/checkpoint", land_in_directory(f"{root}/late"), changed, jobs.ONCE
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/late").select(*[c.split()[0] for c in SCHEMA.split(", ")])


@pytest.mark.parametrize("newest_first", [True, False])
def test_on_time_and_late_are_all(spark, records, tmp_path, newest_first):
    path, root = f"{tmp_path}/in", f"{tmp_path}/out"
    write(records, path, newest_first)
    live = live_metrics(f"{root}/windows", late_by="10 minutes")
    late = run(spark, live, path, root)
    windows = live.windows(spark)
    counted = windows.agg(F.sum("total_processed")).first()[0]
    assert counted + late.count() == records.count()
    without_time = records.filter("kafka_timestamp is null").count()
    if newest_first:
        assert late.count() > without_time
    else:
        assert late.count() == without_time
    on_time = records.join(late.select("id"), "id", "left_anti").select(*records.columns)
    expected = processing_metrics(on_time, "kafka_timestamp")
    assert compare(windows.toPandas(), expected.toPandas()) is None
    # A restart without new files divides nothing anew.
    assert run(spark, live, path, root).count() == late.count()


def test_closed_windows_do_not_change(spark, records, tmp_path):
    path, root = f"{tmp_path}/in", f"{tmp_path}/out"
    write(records.filter("kafka_timestamp is not null"), path, False)
    live = live_evaluation(f"{root}/windows", late_by="2 minutes")
    assert live.windows(spark) is None and live.closed_windows(spark) is None
    states, changed = [], []

    def watch(windows, batch_id):
        changed.append({r.window_start for r in windows.collect()})
        states.append({tuple(r) for r in live.closed_windows(spark).collect()})

    run(spark, live, path, root, watch)
    assert len(states) == 4 and states[0]
    for before, after in zip(states, states[1:], strict=False):
        assert before < after
    for before, touched in zip(states, changed[1:], strict=False):
        assert not {row[0] for row in before} & touched
    everything = windowed_evaluation(records.filter("kafka_timestamp is not null"))
    rounded = [F.round(c, 6).alias(c) for c in ("accuracy", "avg_confidence")]
    keys = ["window_start", "window_end", "total_predictions", "correct_predictions"]
    got, expected = live.windows(spark).select(*keys, *rounded), everything.select(*keys, *rounded)
    assert compare(got.toPandas(), expected.toPandas()) is None


def test_a_replayed_batch_is_divided_as_before(spark, records, tmp_path):
    live = live_metrics(f"{tmp_path}/windows", late_by="1 minute")
    late = []

    def keep(rows, batch_id):
        late.append((batch_id, sorted(r.id for r in rows.select("id").collect())))

    halves = [records.filter(F.col("id").cast("int") >= 200), records.filter(F.col("id").cast("int") < 200)]
    for batch_id, rows in ((0, halves[0]), (1, halves[1]), (1, halves[1])):
        live.handle(rows, batch_id, keep, None)
    assert late[1] == late[2] and len(late[1][1]) > 100
    counted = live.windows(spark).agg(F.sum("total_processed")).first()[0]
    assert counted + len(late[0][1]) + len(late[1][1]) == records.count()


def test_labels_that_come_later(spark, tmp_path, monkeypatch):
    n = F.col("id")
    predictions = spark.range(300).select(
        n.alias("doc_id"), (n % 2).cast("double").alias("prediction"),
        (n % 4 / 4).alias("confidence"), F.timestamp_seconds(n * 15 + 1_700_000_000).alias("kafka_timestamp"),
    )
    labels = spark.range(0, 300, 2).select(
        n.alias("doc_id"), (n % 3).cast("double").alias("label"),
        F.timestamp_seconds(n * 15 + 1_700_000_400).alias("label_timestamp"),
    )
    streams = []
    for name, table in (("predictions", predictions), ("labels", labels)):
        parts = table.withColumn("part", F.ntile(3).over(Window.orderBy("doc_id")))
        for part in range(1, 4):
            parts.filter(F.col("part") == part).drop("part").coalesce(1).write.parquet(
                f"{tmp_path}/{name}/part={part}"
            )
        reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        streams.append(reader.parquet(f"{tmp_path}/{name}/part=*"))
    monkeypatch.setattr(jobs, "every", lambda interval: jobs.ONCE)
    config = PulseConfig(checkpoint_root=str(tmp_path / "c"), late_by="1 hour")
    late = land_in_directory(f"{tmp_path}/late")
    query = apps.evaluate(*streams, config, f"{tmp_path}/windows", late)
    query.awaitTermination()
    assert rows_dropped(query) == 0
    assert spark.read.parquet(f"{tmp_path}/late").count() == 0
    joined = join_labels(predictions, labels)
    assert joined.count() == 150
    got = live_evaluation(f"{tmp_path}/windows").windows(spark)
    assert compare(got.toPandas(), windowed_evaluation(joined).toPandas()) is None
    assert join_labels(predictions, labels, wait="5 minutes").count() == 0
