"""Models on disk: versions, pointers, and streams that change over between batches."""

import time

import pytest
from pyspark.sql import functions as F

from tests.support import SMALL, compare
from textpulse.catalog.queries import fixed_now
from textpulse.operators.model import apply_model, default_model, hybrid_scorer, train
from textpulse.operators.model_store import ModelStore
from textpulse.plans.content import processed_rows, route
from textpulse.sources import bus
from textpulse.sources import tables as tb
from textpulse.streaming import jobs


@pytest.fixture(scope="module")
def other_model(spark):
    """Whatever it reads, it is sure to find it good."""
    rows = [(2, "alpha beta"), (2, "gamma delta"), (0, "omega")]
    return train(spark.createDataFrame(rows, "label int, text string").coalesce(1))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory, other_model):
    store = ModelStore(spark, str(tmp_path_factory.mktemp("models")))
    store.save(default_model(spark), "2.0")
    store.save(other_model, "2.1", publish=False)
    return store


def test_versions_and_the_current_one(spark, store, tmp_path):
    assert store.versions() == ["2.0", "2.1"] and store.current() == "2.0"
    store.publish("2.1")
    assert ModelStore(spark, store.path).current() == "2.1"
    store.publish("2.0")
    assert store.current() == "2.0"
    for wrong in ("3", "", "../2.0", "_published"):
        with pytest.raises(ValueError):
            store.publish(wrong)
    with pytest.raises(ValueError):
        store.save(default_model(spark), "a/b")
    with pytest.raises(Exception, match="exist"):
        store.save(default_model(spark), "2.0")
    empty = ModelStore(spark, str(tmp_path / "none"))
    assert empty.current() is None
    with pytest.raises(ValueError):
        empty.load()


def test_a_saved_model_is_read_soon_and_judges_alike(spark, store):
    rows = tb.posts(tb.read_table(spark, SMALL, "documents")).select(
        "doc_id", F.col("title").alias("text")
    )
    begin = time.perf_counter()
    loaded = ModelStore(spark, store.path).load("2.0")
    assert time.perf_counter() - begin < 15
    fields = ["doc_id", "prediction", F.col("probability").cast("string")]
    got = apply_model(loaded, rows).select(*fields).toPandas()
    assert compare(got, apply_model(default_model(spark), rows).select(*fields).toPandas()) is None


def test_a_stream_takes_up_a_new_version_between_batches(spark, store, other_model, tmp_path):
    posts = tb.post_envelopes(tb.read_table(spark, SMALL, "documents"))
    halves = [posts.filter(F.length("key") % 2 == n).drop("content_type") for n in range(2)]
    for part, half in enumerate(halves):
        half.coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    landed = {}

    def take(batch, batch_id):
        landed[batch_id] = batch.toPandas()
        # Published while the first batch is in the sinks; the second batch is scored by it.
        store.publish("2.1")

    store.publish("2.0")
    stream = bus.directory_stream(spark, f"{tmp_path}/in/part=*", "post", max_files_per_trigger=1)
    jobs.start_scoring(
        stream, f"{tmp_path}/c", processed=[take], now=fixed_now(), trigger=jobs.ONCE, models=store
    ).awaitTermination()
    assert [set(landed[n]["model_version"]) for n in sorted(landed)] == [{"2.0"}, {"2.1"}]
    expected = {}
    for model, version in ((default_model(spark), "2.0"), (other_model, "2.1")):
        routed = route(posts, scorer=hybrid_scorer(model))
        for row in processed_rows(routed, now=fixed_now()).collect():
            expected[row.id, version] = (row.sentiment, row.confidence)
    for frame in landed.values():
        for row in frame.itertuples():
            assert (row.sentiment, row.confidence) == expected[row.id, row.model_version]
    store.publish("2.0")
