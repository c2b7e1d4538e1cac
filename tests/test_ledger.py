"""Sinks that fail get their batch again, the others do not."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.support import SMALL
from textpulse.catalog.queries import fixed_now
from textpulse.config import PulseConfig
from textpulse.plans.content import failures, processed_rows, route
from textpulse.schemas import ENVELOPE
from textpulse.sinks.tables import land_in_directory
from textpulse.sources import bus
from textpulse.sources import tables as tb
from textpulse.streaming import apps, jobs
from textpulse.streaming.ledger import BATCHES_KEPT, SinkLedger


def test_entries_survive_and_are_forgotten(spark, tmp_path):
    taken = []
    for batch in range(BATCHES_KEPT + 10):
        book = SinkLedger(spark, str(tmp_path / "l"), "q")
        book.deliver(batch, {"a": lambda: taken.append("a"), "b": lambda: taken.append("b")})
        book.deliver(batch, {"a": lambda: taken.append("again")})
    assert taken == ["a", "b"] * (BATCHES_KEPT + 10)
    assert len(list((tmp_path / "l" / "q").glob("[0-9]*"))) <= 2 * (BATCHES_KEPT + 1)
    assert not SinkLedger(spark, str(tmp_path / "l"), "other").has(3, "a")


@pytest.fixture(scope="module")
def posts(spark):
    return tb.post_envelopes(tb.read_table(spark, SMALL, "documents")).cache()


def test_a_failing_sink_gets_its_batch_again_alone(spark, posts, tmp_path):
    for part in range(2):
        posts.drop("content_type").filter(F.length("key") % 2 == part).write.parquet(
            f"{tmp_path}/in/part={part}"
        )
    taken = {"first": [], "failing": [], "last": [], "dead": []}
    broken = [True]

    def sink(name):
        def take(batch, batch_id):
            if name == "failing" and batch_id == 1 and broken.pop():
                broken.append(False)
                raise RuntimeError("not now")
            taken[name].append((batch_id, batch.count()))

        return take

    def run():
        stream = bus.directory_stream(spark, f"{tmp_path}/in/part=*", "post", max_files_per_trigger=8)
        query = jobs.start_scoring(
            stream,
            f"{tmp_path}/checkpoint",
            processed=[sink("first"), sink("failing"), sink("last")],
            dead=[sink("dead")],
            now=fixed_now(),
            trigger=jobs.ONCE,
            ledger=f"{tmp_path}/ledger",
        )
        query.awaitTermination()

    try:
        run()
    except StreamingQueryException:
        pass
    if not taken["failing"] or len(taken["failing"]) < len(taken["first"]):
        # The others have had the batch, as far as the query came.
        assert taken["first"] == taken["last"]
        broken[:] = [False]
        run()
    assert taken["first"] == taken["failing"] == taken["last"]
    assert len({b for b, _ in taken["dead"]}) == len(taken["dead"])
    routed = route(posts)
    assert sum(n for _, n in taken["first"]) == processed_rows(routed).count()
    assert sum(n for _, n in taken["dead"]) == failures(routed).count()


def test_dead_letters_go_out_at_their_own_pace(spark, posts, tmp_path, monkeypatch):
    def read_topic(session, config, topic, max_per_trigger=None):
        return session.readStream.schema(ENVELOPE).parquet(str(tmp_path / topic))

    published, intervals = [], []

    def every(interval):
        intervals.append(interval)
        return jobs.ONCE

    monkeypatch.setattr(bus, "read_topic", read_topic)
    monkeypatch.setattr(jobs, "publish", lambda messages, config, topic=None: published.append(topic))
    monkeypatch.setattr(jobs, "every", every)
    config = PulseConfig(
        checkpoint_root=str(tmp_path / "c"), dead_letter_staging=str(tmp_path / "dead")
    )
    for kind in ("post", "comment"):
        posts.drop("content_type").write.parquet(str(tmp_path / config.topic_for(kind)))
    apps.score(spark, config).awaitTermination()
    assert published == [config.processed_topic]
    waiting = spark.read.parquet(str(tmp_path / "dead")).count()
    assert waiting > 0
    sent = []

    def start_publishing(messages, checkpoint, config, topic, trigger, name):
        sink = land_in_directory(str(tmp_path / "sent"))
        sent.append((topic, trigger, name))
        return jobs.start_landing(messages, checkpoint, sink, trigger, name)

    monkeypatch.setattr(jobs, "start_publishing", start_publishing)
    apps.report_dead_letters(spark, config).awaitTermination()
    assert sent == [(config.dead_letter_topic, jobs.ONCE, "report_dead_letters")]
    assert config.dead_letter_every in intervals
    assert spark.read.parquet(str(tmp_path / "sent")).count() == waiting
    with pytest.raises(ValueError):
        apps.report_dead_letters(spark, PulseConfig(checkpoint_root="/c"))
