"""First copies of a stream: bounded reads, any order of batches, restarts, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.support import compare
from textpulse.operators.dedup import keep_first_seen
from textpulse.operators.first_copies import SUPERSEDES, earliest, first_copies
from textpulse.sinks.tables import BATCH_COLUMNS, land_in_directory
from textpulse.streaming import jobs

SCHEMA = (
    "content_type string, id string, kafka_timestamp timestamp, content string, "
    "kafka_key binary, score int, created_utc long, weight double"
)


def rows_of(spark, rows):
    frame = spark.createDataFrame(rows, "content_type string, id string, t double, content string, n long")
    return frame.select(
        "content_type", "id",
        F.timestamp_micros((F.col("t") * 1e6).cast("bigint")).alias("kafka_timestamp"),
        "content",
        F.encode("content", "utf-8").alias("kafka_key"),
        F.col("n").cast("int").alias("score"),
        F.when(F.col("n").isNotNull(), F.lit(9007199254740993) + F.col("n")).alias("created_utc"),
        F.when(F.col("n") != 3, F.col("n") / 3).when(F.col("n") == 3, F.lit(float("nan"))).alias("weight"),
    )


def land(spark, path, root, per_batch=1):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch)
    query = jobs.start_landing(
        first_copies(stream.parquet(f"{path}/part=*")),
        f"{root}/checkpoint",
        land_in_directory(f"{root}/landed"),
        jobs.ONCE,
    )
    query.awaitTermination()
    return query


def landed(spark, root):
    return spark.read.parquet(f"{root}/landed").drop(*BATCH_COLUMNS)


@pytest.fixture
def few_partitions(spark):
    settings = {
        "spark.sql.shuffle.partitions": "2",
        "spark.sql.streaming.numRecentProgressUpdates": "300",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def expected_first(frame):
    """The earliest copy, without a time last; no two copies here have the same time."""
    order = F.struct(F.col("kafka_timestamp").isNull(), "kafka_timestamp")
    rest = [c for c in frame.columns if c not in ("content_type", "id")]
    first = F.min_by(F.struct(*rest), order).alias("f")
    return frame.groupBy("content_type", "id").agg(first).select("content_type", "id", "f.*")


@pytest.mark.parametrize("order", ["oldest", "newest", "mixed"])
def test_the_earliest_copy_in_any_order_of_batches(spark, tmp_path, few_partitions, order):
    rng = random.Random(5)
    rows = []
    for n in range(240):
        key = rng.randrange(60)
        time = None if n % 40 == 7 else float(n) + 0.000001
        rows.append((
            rng.choice(["post", None]), None if key == 5 else f"k{key}", time,
            None if n % 9 == 0 else f"text {n} é", None if n % 7 == 0 else n % 5,
        ))
    # At most one row of a key is without a time.
    seen, kept = set(), []
    for row in rows:
        if row[2] is None and row[:2] in seen:
            continue
        if row[2] is None:
            seen.add(row[:2])
        kept.append(row)
    if order == "newest":
        kept.reverse()
    elif order == "mixed":
        rng.shuffle(kept)
    for part in range(6):
        rows_of(spark, kept[part::6] if order == "mixed" else kept[part * 40 : part * 40 + 40]).coalesce(
            1
        ).write.parquet(f"{tmp_path}/in/part={part}")
    land(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = landed(spark, f"{tmp_path}/out")
    expected = expected_first(rows_of(spark, kept))
    assert compare(earliest(got).toPandas(), expected.toPandas()) is None
    # The stream's own rows name each key once but for copies that came late and are earlier.
    fresh = got.filter(~F.col(SUPERSEDES))
    assert fresh.select("content_type", "id").distinct().count() == fresh.count()
    if order == "oldest":
        # Only a copy with a time supersedes one without.
        late = got.filter(SUPERSEDES).select("content_type", "id").collect()
        assert {tuple(r) for r in late} <= {row[:2] for row in kept if row[2] is None}


def test_keys_are_remembered_over_restarts(spark, tmp_path, few_partitions):
    first = [("post", f"k{n}", float(n), "a", n) for n in range(50)]
    rows_of(spark, first).write.parquet(f"{tmp_path}/in/part=0")
    land(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    again = [("post", f"k{n}", float(n) + 100, "b", n) for n in range(60)]
    rows_of(spark, again).write.parquet(f"{tmp_path}/in/part=1")
    land(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = landed(spark, f"{tmp_path}/out")
    assert got.count() == 60 and got.filter("content = 'b'").count() == 10
    assert not got.filter(SUPERSEDES).count()


def test_copies_of_one_time_are_chosen_alike(spark, tmp_path, few_partitions):
    copies = [("post", "k", 1.0, f"text {n}", n) for n in range(8)]
    results = []
    for attempt, order in enumerate((copies, copies[::-1])):
        for part in range(4):
            rows_of(spark, order[part * 2 : part * 2 + 2]).coalesce(1).write.parquet(
                f"{tmp_path}/in{attempt}/part={part}"
            )
        land(spark, f"{tmp_path}/in{attempt}", f"{tmp_path}/out{attempt}")
        results.append([r.content for r in earliest(landed(spark, f"{tmp_path}/out{attempt}")).collect()])
    assert results[0] == results[1] and len(results[0]) == 1


def carried(spark, path, batches, keys=40):
    """Batches with new keys and copies of earlier ones, each a file."""
    rng = random.Random(6)
    made, again = [], []
    for part in range(batches):
        again += [(*rng.choice(made)[:2], float(part), "again", part) for _ in range(8) if made]
        made += [("post", f"t3_{part:05d}{n:05d}", float(part), "x", part) for n in range(keys)]
    rows = rows_of(spark, made + again).withColumn("part", F.col("score"))
    rows.repartition(8, "part").write.partitionBy("part").parquet(path)
    return len(made)


def test_batches_look_up_what_they_carry(spark, tmp_path, few_partitions):
    """The state store reports the bytes that its look-ups return; landed tables are not read."""
    made = carried(spark, f"{tmp_path}/in", 30)
    query = land(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 30
    store = [[op["customMetrics"] for op in p["stateOperators"]] for p in batches]
    read = [sum(int(m["rocksdbTotalBytesRead"]) for m in ops) for ops in store]
    looked_up = [sum(int(m["rocksdbGetCount"]) for m in ops) for ops in store]
    bytes_carried = sum(p["numInputRows"] * len("post" + "t3_0000000000") for p in batches)
    assert sum(read) <= 2 * bytes_carried
    # No batch does more work because of the batches before it.
    assert max(looked_up[15:]) <= 2 * max(looked_up[1:15])
    assert landed(spark, f"{tmp_path}/out").filter(~F.col(SUPERSEDES)).count() == made


def test_a_hundred_landed_batches_are_read_about_twice(spark, tmp_path, few_partitions):
    """Merging reads every row once a level and nothing else."""
    path = f"{tmp_path}/table"
    table = jobs.first_seen_table(spark, path)
    read = []
    merge = table.merge

    def counted(rows):
        read.append(rows.count())
        return merge(rows)

    table.merge = counted
    made = carried(spark, f"{tmp_path}/in", 100, keys=10)
    given = spark.read.schema(SCHEMA + ", part int").parquet(f"{tmp_path}/in")
    rows = given.collect()
    # Newest batches first: the earliest copies come last.
    for batch, part in enumerate(reversed(range(100))):
        some = spark.createDataFrame([r[:-1] for r in rows if r.part == part], SCHEMA).coalesce(1)
        table.land(some, batch, "q")
    assert sum(read) <= 2 * len(rows)
    assert len(table.manifest().parts) <= 2 * 8 + 1
    got = jobs.first_rows(spark, path)
    assert got.count() == made
    expected = expected_first(given.drop("part"))
    assert compare(got.toPandas(), expected.toPandas()) is None
    assert jobs.first_rows(spark, f"{tmp_path}/none") is None


def test_nested_rows_are_refused(spark, tmp_path):
    nested = spark.readStream.format("rate").load().select(
        F.lit("post").alias("content_type"), F.lit("a").alias("id"),
        F.col("timestamp").alias("kafka_timestamp"), F.array(F.lit(1)).alias("many"),
    )
    with pytest.raises(ValueError):
        first_copies(nested)


def test_no_landed_rows(spark):
    empty = rows_of(spark, []).withColumn(SUPERSEDES, F.lit(False))
    assert earliest(empty).count() == 0


def test_null_keys_are_known_in_the_small_table_sink(spark, tmp_path):
    keep = keep_first_seen(f"{tmp_path}/t")
    for batch in range(2):
        rows = [("post", None, 1.0 + batch, "a", 1), (None, "k", 1.0 + batch, "a", 1)]
        keep(rows_of(spark, [*rows, ("post", f"k{batch}", 1.0, "a", 1)]), batch)
    landed = spark.read.parquet(f"{tmp_path}/t").groupBy("content_type", "id").count().collect()
    assert sorted((r.id or "", r["count"]) for r in landed) == [("", 1), ("k", 1), ("k0", 1), ("k1", 1)]
