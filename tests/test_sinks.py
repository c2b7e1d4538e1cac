"""Messages, previews and idempotent landing."""

import json
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.support import SMALL, compare
from textpulse.catalog.queries import fixed_now
from textpulse.config import PulseConfig
from textpulse.operators.routing import dead_letters, parse_failures, parse_messages
from textpulse.plans.content import processed_rows, route
from textpulse.schemas import PROCESSED
from textpulse.sinks import messages as out
from textpulse.sinks.tables import (
    RelationalTarget,
    land_in_database,
    land_in_directory,
    target_from_config,
)
from textpulse.sources import bus
from textpulse.sources import tables as tb
from textpulse.sources.records import decode_dead_letters, decode_processed


@pytest.fixture(scope="module")
def processed(spark):
    posts = tb.post_envelopes(tb.read_table(spark, SMALL, "documents"))
    return processed_rows(route(posts), now=fixed_now())


def test_round_trip(processed):
    back = decode_processed(out.encode_processed(processed))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in PROCESSED]
    expected = processed.withColumnRenamed("content", "original_content").select(
        *PROCESSED.fieldNames()
    )
    assert compare(back.toPandas(), expected.toPandas()) is None


def test_encoding_keeps_milliseconds_and_leaves_nulls_out(spark):
    row = {name: None for name in PROCESSED.fieldNames() if name != "original_content"}
    at = datetime(2024, 2, 1, 0, 0, 0, 123456)
    row |= {"id": "1", "content": "c", "processing_timestamp": at}
    schema = processed_schema_with_content()
    df = spark.createDataFrame([row], schema)
    message = out.encode_processed(df).first()
    assert message.key == "1"
    assert json.loads(message.value) == {
        "id": "1",
        "original_content": "c",
        "processing_timestamp": "2024-02-01T00:00:00.123Z",
    }


def processed_schema_with_content():
    from pyspark.sql import types as T

    return T.StructType(
        [
            T.StructField("content" if f.name == "original_content" else f.name, f.dataType)
            for f in PROCESSED
        ]
    )


def test_malformed_records_become_null_rows(spark):
    df = spark.createDataFrame([("not json",), ("",), (None,), ('{"id":"1"}',)], "value string")
    rows = decode_processed(df).collect()
    assert [r.id for r in rows] == [None, None, None, "1"]
    assert all(v is None for r in rows[:3] for v in r)
    dead = decode_dead_letters(df.union(spark.createDataFrame([('{"timestamp":60}',)], "value string")))
    assert dead.orderBy(F.desc("timestamp")).first().error_timestamp == datetime(1970, 1, 1, 0, 1)


def test_previews(spark, processed):
    row = out.result_preview(processed.filter("id = '7'")).first()
    assert len(row.content_preview) == 60 and row.conf == 0.8
    failed = parse_failures(parse_messages(tb.post_envelopes(tb.read_table(spark, SMALL, "documents"))))
    preview = out.dead_letter_preview(failed, fixed_now())
    assert preview.columns == [
        "Topic", "Error Type", "Error Message", "Message Preview", "Timestamp",
    ]
    assert preview.filter(F.length("Message Preview") > 50).count() == 0
    value = json.loads(out.encode_dead_letters(dead_letters(failed, fixed_now())).first().value)
    assert value["retry_count"] == 0 and value["timestamp"] == 1706745600


def test_a_new_checkpoint_adds_and_a_replay_replaces(spark, tmp_path):
    source, landed = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(413).write.parquet(f"{source}/part=0")

    def run(checkpoint):
        stream = spark.readStream.schema("id long").parquet(f"{source}/part=*")
        writer = stream.writeStream.foreachBatch(land_in_directory(landed))
        writer = writer.option("checkpointLocation", str(tmp_path / checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(landed).count()

    assert run("one") == run("one") == 413
    # The commit of the batch is lost: it runs again under the same query.
    for name in (tmp_path / "one" / "commits").iterdir():
        name.unlink()
    assert run("one") == 413
    spark.range(410).write.mode("overwrite").parquet(f"{source}/part=0")
    assert run("two") == 823


def test_directory_landing_replaces_a_replayed_batch(spark, tmp_path):
    land = land_in_directory(str(tmp_path / "t"))
    land(spark.range(5), 0)
    land(spark.range(3), 1)
    land(spark.range(5), 0)
    got = {r.batch_id: r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("batch_id").count().collect()}
    assert got == {0: 5, 1: 3}


class Connection:
    """The oracle's in-process engine with the few PEP 249 methods the sink uses."""

    def __init__(self, engine):
        self.engine = engine
        engine.execute("begin transaction")

    def cursor(self):
        return self

    def execute(self, statement, values):
        self.engine.execute(statement, list(values))

    def commit(self):
        self.engine.execute("commit")

    def close(self):
        pass


def test_database_landing_survives_replays_and_repeated_tasks(spark, tmp_path):
    engine = duckdb.connect()
    columns = "stream_name text, query_id text, batch_id bigint, {} id text, n int"
    engine.execute(f"create table t ({columns.format('')})")
    engine.execute(f"create table t_staging ({columns.format('row_number_in_batch bigint,')})")
    target = RelationalTarget(
        url="jdbc:none", table="t", columns=("id", "n"), stream="s", connect=lambda: Connection(engine)
    )
    attempts = []

    def stage(rows, to):
        path = str(tmp_path / f"stage{len(attempts)}")
        rows.write.parquet(path)
        # The last rows twice, as if a task was lost after it had committed.
        engine.execute(f"insert into {to.staging} select * from '{path}/*.parquet'")
        engine.execute(
            f"insert into {to.staging} select * from '{path}/*.parquet' where row_number_in_batch % 2 = 0"
        )
        attempts.append(path)
        if len(attempts) == 2:
            raise RuntimeError("lost")

    land = land_in_database(target, stage)
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "id string, n int").coalesce(1)
    land(batch, 0)
    with pytest.raises(RuntimeError):
        land(batch, 1)
    land(batch, 1)
    land(batch, 0)
    got = engine.execute("select batch_id, id, n from t order by all").fetchall()
    assert got == [(b, *row) for b in (0, 1) for row in [("a", 1), ("a", 1), ("b", 2)]]
    assert engine.execute("select count(*) from t_staging").fetchall() == [(0,)]


@pytest.mark.parametrize(
    "style, tests, values",
    [
        ("qmark", "stream_name = ? AND query_id = ? AND batch_id = ?", ("s", "q", 3)),
        ("format", "stream_name = %s AND query_id = %s AND batch_id = %s", ("s", "q", 3)),
        ("numeric", "stream_name = :1 AND query_id = :2 AND batch_id = :3", ("s", "q", 3)),
        (
            "named",
            "stream_name = :stream_name AND query_id = :query_id AND batch_id = :batch_id",
            {"stream_name": "s", "query_id": "q", "batch_id": 3},
        ),
        (
            "pyformat",
            "stream_name = %(stream_name)s AND query_id = %(query_id)s AND batch_id = %(batch_id)s",
            {"stream_name": "s", "query_id": "q", "batch_id": 3},
        ),
    ],
)
def test_statements_in_the_style_of_the_driver(style, tests, values):
    target = RelationalTarget("jdbc:none", "t", ("id",), "s", lambda: None, paramstyle=style)
    assert target.clear_staging() == f"DELETE FROM t_staging WHERE {tests}"
    assert target.remove_batch() == f"DELETE FROM t WHERE {tests}"
    assert target.move_batch() == (
        "INSERT INTO t (stream_name, query_id, batch_id, id) SELECT stream_name, query_id, "
        "batch_id, id FROM (SELECT DISTINCT row_number_in_batch, stream_name, query_id, batch_id, "
        f"id FROM t_staging WHERE {tests}) AS batch"
    )
    assert target.values("q", 3) == values


def test_unknown_style():
    with pytest.raises(ValueError):
        RelationalTarget("u", "t", ("id",), "s", lambda: None, paramstyle="x").clear_staging()


def test_database_settings_come_from_the_configuration():
    config = PulseConfig.from_env(
        {"TEXTPULSE_JDBC_URL": "jdbc:x", "TEXTPULSE_JDBC_USER": "me", "TEXTPULSE_JDBC_PASSWORD": "pw"}
    )
    target = target_from_config(config, "s", "t", ("id",), lambda: None, driver="d")
    assert target.jdbc_options() == {
        "url": "jdbc:x", "dbtable": "t_staging", "user": "me", "password": "pw", "driver": "d",
    }
    assert "pw" not in repr(config) and "pw" not in repr(target)
    with pytest.raises(ValueError):
        target_from_config(PulseConfig(), "s", "t", ("id",), lambda: None)


def test_bus_options():
    config = PulseConfig(bootstrap_servers="b:1")
    assert bus.topic_options(config, "t", 1000) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "maxOffsetsPerTrigger" not in bus.topic_options(config, "t")
    careful = PulseConfig(starting_offsets="earliest", fail_on_data_loss=True)
    options = bus.topic_options(careful, "t", careful.max_records_per_trigger)
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "true")
    assert "maxOffsetsPerTrigger" not in options
    assert out.topic_writer_options(config, "t")["topic"] == "t"
    assert "topic" not in out.topic_writer_options(config)


def test_environment_keeps_types():
    config = PulseConfig.from_env({"TEXTPULSE_MIN_TEXT_LENGTH": "3", "TEXTPULSE_MIN_CONFIDENCE": "0.5"})
    assert (config.min_text_length, config.min_confidence) == (3, 0.5)
    assert config.model_version == "1.2"
    assert config.remember_ids_for is None and config.max_records_per_trigger is None
    env = {"TEXTPULSE_REMEMBER_IDS_FOR": "7 days", "TEXTPULSE_MAX_RECORDS_PER_TRIGGER": "1000",
           "TEXTPULSE_FAIL_ON_DATA_LOSS": "true"}
    config = PulseConfig.from_env(env)
    assert (config.remember_ids_for, config.max_records_per_trigger) == ("7 days", 1000)
    assert config.fail_on_data_loss is True
    unset = PulseConfig.from_env({"TEXTPULSE_REMEMBER_IDS_FOR": "None", "TEXTPULSE_MAX_RECORDS_PER_TRIGGER": ""})
    assert unset.remember_ids_for is None and unset.max_records_per_trigger is None
