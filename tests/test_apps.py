"""The applications with directories in place of the bus."""

import pytest
from pyspark.sql import functions as F

from tests.support import SMALL, rows
from textpulse.catalog.queries import fixed_now
from textpulse.config import PulseConfig
from textpulse.operators.metrics import processing_metrics
from textpulse.operators.routing import dead_letters
from textpulse.plans.content import failures, processed_rows, route
from textpulse.schemas import ENVELOPE
from textpulse.sinks.messages import encode_dead_letters, encode_processed
from textpulse.sinks.tables import land_in_directory
from textpulse.sources import bus
from textpulse.sources import tables as tb
from textpulse.sources.listings import flatten_listings
from textpulse.streaming import apps, jobs


@pytest.fixture
def directories(spark, tmp_path, monkeypatch):
    """Topics are folders below ``tmp_path``; every query drains its input and stops."""

    def read_topic(session, config, topic, max_per_trigger=None):
        return session.readStream.schema(ENVELOPE).parquet(str(tmp_path / topic))

    sent = {}

    def publish(messages, config, topic=None):
        sent.setdefault(topic, []).extend(r.value for r in messages.collect())

    monkeypatch.setattr(bus, "read_topic", read_topic)
    monkeypatch.setattr(jobs, "publish", publish)
    monkeypatch.setattr(jobs, "every", lambda interval: jobs.ONCE)
    return tmp_path, PulseConfig(checkpoint_root=str(tmp_path / "checkpoints")), sent


def envelopes(spark):
    return tb.all_envelopes(
        tb.read_table(spark, SMALL, "documents"), tb.read_table(spark, SMALL, "conversations")
    )


def test_scoring(spark, directories, capfd):
    path, config, sent = directories
    for kind in ("post", "comment"):
        part = envelopes(spark).filter(F.col("content_type") == kind).drop("content_type")
        part.write.parquet(str(path / config.topic_for(kind)))
    apps.score(spark, config).awaitTermination()
    routed = route(envelopes(spark))
    ignoring_clock = F.regexp_replace("value", '"(processing_timestamp|timestamp)":[^,]+,', "")
    for topic, expected in (
        (config.processed_topic, encode_processed(processed_rows(routed))),
        (config.dead_letter_topic, encode_dead_letters(dead_letters(failures(routed)))),
    ):
        got = spark.createDataFrame([(v,) for v in sent[topic]], "value string")
        assert rows(got.select(ignoring_clock.alias("v")).toPandas()) == rows(
            expected.select(ignoring_clock.alias("v")).toPandas()
        )
    printed = capfd.readouterr().out
    assert "content_preview" in printed and "Message Preview" in printed


def test_landing(spark, directories, monkeypatch):
    path, config, _ = directories
    routed = route(envelopes(spark))
    for topic, messages in (
        (config.processed_topic, encode_processed(processed_rows(routed))),
        (config.dead_letter_topic, encode_dead_letters(dead_letters(failures(routed)))),
    ):
        messages.select(
            F.lit(None).cast("binary").alias("key"),
            F.encode("value", "utf-8").alias("value"),
            F.current_timestamp().alias("timestamp"),
        ).write.parquet(str(path / topic))
    landed = []

    def in_directory(target):
        landed.append((target.table, target.columns))
        return land_in_directory(str(path / "landed" / target.table))

    monkeypatch.setattr(apps, "land_in_database", in_directory)
    queries = apps.land(spark, config.with_options(jdbc_url="jdbc:none"), lambda: None)
    for query in queries:
        query.awaitTermination()
    for (table, columns), expected in zip(landed, (processed_rows(routed), failures(routed))):
        frame = spark.read.parquet(str(path / "landed" / table))
        assert set(columns) <= set(frame.columns)
        assert frame.count() == expected.count()


def test_measure(spark, directories):
    path, config, _ = directories
    processed = processed_rows(route(envelopes(spark)), now=fixed_now())
    encode_processed(processed).select(
        F.encode("key", "utf-8").alias("key"),
        F.encode("value", "utf-8").alias("value"),
        F.current_timestamp().alias("timestamp"),
    ).write.parquet(str(path / config.processed_topic))
    apps.measure(spark, config, str(path / "windows")).awaitTermination()
    got = jobs.latest_metrics(spark, str(path / "windows"))
    columns = ["content_type", "subreddit", "total_processed", "max_engagement"]
    expected = processing_metrics(processed).select(columns)
    assert rows(got.select(columns).toPandas()) == rows(expected.toPandas())


def test_ingest(spark, directories, monkeypatch):
    path, config, _ = directories
    posts = tb.post_listings(tb.read_table(spark, SMALL, "documents"))
    comments = tb.comment_listings(tb.read_table(spark, SMALL, "conversations"))
    posts.union(posts).write.parquet(str(path / "listings" / "post"))
    comments.write.parquet(str(path / "listings" / "comment"))
    streams = [
        spark.readStream.schema(posts.schema).parquet(str(path / "listings" / kind))
        for kind in ("post", "comment")
    ]

    def start_publishing(messages, checkpoint, config, topic=None, trigger=None, name=None):
        assert topic is None
        return jobs.start_landing(
            messages, checkpoint, land_in_directory(str(path / "sent")), jobs.ONCE
        )

    monkeypatch.setattr(jobs, "start_publishing", start_publishing)
    apps.ingest(*streams, config).awaitTermination()
    sent = spark.read.parquet(str(path / "sent"))
    counts = {r.topic: r["count"] for r in sent.groupBy("topic").count().collect()}
    assert counts == {
        "posts": flatten_listings(posts, "post").select("id").distinct().count(),
        "comments": flatten_listings(comments, "comment").select("id").distinct().count(),
    }
    fields = sent.filter("topic = 'comments'").select(F.json_object_keys("value").alias("k")).first().k
    assert fields == ["id", "body", "author", "subreddit", "score", "created_utc", "parent_id"]


def test_previews_are_limited():
    seen = []
    sink = jobs.at_most_every("1 minute", lambda batch, n: seen.append(n))
    for n in range(3):
        sink(None, n)
    assert seen == [0]
