"""Keep the first message seen per content type and id."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.sinks.tables import land_in_directory, streaming_query_id

KEYS = ("content_type", "id")


def first_seen(
    df: DataFrame, keys: Sequence[str] = KEYS, arrival: str = "kafka_timestamp"
) -> DataFrame:
    """The earliest row per key, whole; rows without a time come last.

    A narrow aggregate finds each key's first place, by time and then by a digest of the other
    columns, which makes the choice among simultaneous copies definite; no text is kept in it,
    and copies of a hot id are reduced to one place per input partition before they move. Rows
    then meet the first places by key and place together, so that copies of a hot id spread
    over the tasks, and only rows that are equal in all columns are left to be made one.
    """
    names = df.columns
    others = [name for name in names if name not in (*keys, arrival)]
    digest = F.xxhash64(*others) if others else F.lit(0).cast("bigint")
    placed = df.withColumn("_digest", digest)
    place = F.struct(F.col(arrival).isNull().alias("late"), F.col(arrival).alias("time"), "_digest")
    renamed = {key: f"_key_{key}" for key in keys}
    first = placed.groupBy(*[F.col(key).alias(name) for key, name in renamed.items()])
    first = first.agg(F.min(place).alias("_first")).select(
        *renamed.values(),
        F.col("_first.time").alias("_time"),
        F.col("_first._digest").alias("_first_digest"),
    )
    first = first.withColumn("_first_place", F.xxhash64(*renamed.values(), "_time", "_first_digest"))
    placed = placed.withColumn("_place", F.xxhash64(*keys, arrival, "_digest"))
    # The hash deals the rows out; the columns themselves decide.
    same = [F.col("_place") == F.col("_first_place"), F.col("_digest") == F.col("_first_digest")]
    same += [F.col(key).eqNullSafe(F.col(name)) for key, name in renamed.items()]
    same.append(F.col(arrival).eqNullSafe(F.col("_time")))
    chosen = placed.join(first, same).select(*names, "_place")
    return chosen.dropDuplicates(["_place", *keys]).select(*names)


def first_seen_stream(
    df: DataFrame,
    remember_for: str | None,
    keys: Sequence[str] = KEYS,
    arrival: str = "kafka_timestamp",
) -> DataFrame:
    """One row per key of a stream; a key is remembered for that long in event time.

    ``None`` remembers every key for ever: nothing is dropped as late, and the state grows
    with the keys. With a time, rows later than it are dropped, new keys among them. Of
    copies in one micro-batch any may stay; ``keep_first_seen`` keeps the earliest.
    """
    if remember_for is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(arrival, remember_for).dropDuplicatesWithinWatermark(list(keys))


def keep_first_seen(
    path: str,
    keys: Sequence[str] = KEYS,
    arrival: str = "kafka_timestamp",
) -> Callable[[DataFrame, int], None]:
    """A sink that lands the first row of every key of a stream and no other.

    The landed table is the memory: a batch lands its earliest row of each key that no other
    batch has landed. A replayed batch does not see its own rows, so it lands the same again.
    Nothing is ever too late. Every batch reads the keys of the whole landed table, so this is for
    small tables that other programs read as they lie; ``jobs.land_first_seen`` reads none.
    """
    land = land_in_directory(path)

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = first_seen(batch, keys, arrival)
        try:
            landed = spark.read.parquet(path)
        except AnalysisException:
            # Nothing has been landed yet.
            landed = None
        if landed is not None:
            own = (F.col("query_id") == streaming_query_id(batch)) & (F.col("batch_id") == batch_id)
            known = landed.filter(~own).select(*[F.col(k).alias(f"_known_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
            fresh = fresh.join(known, same, "left_anti").select(*batch.columns)
        land(fresh, batch_id)

    return keep
