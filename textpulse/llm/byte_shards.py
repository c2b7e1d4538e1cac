"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned into one global order and numbered by partition. Totals per
partition, a few numbers each, become offsets; inside a partition a running sum adds to the
offset, so no task ever sees more than its own partition. Cutting the line of bytes at equal
targets gives contiguous shards that differ from the target by less than one document.

The order is by id, checksum and size; a row number as last key lets Spark cut between rows
that agree in all of them, as copies of one hot id would.

Cases: a null text has no bytes and the checksum of the empty text, 0; a null id sorts first.
Repeated rows each get a slot. A document larger than a target may leave a shard without
rows. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import quoted, text_or_empty, written

OVERHEAD = 8
ORDER = ("doc_id", "text_crc32", "size", "_tie")


def sizes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id, bytes and checksum of each row: all that sharding needs."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text_or_empty("text").cast("binary")).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("_tie"),
    )


def balanced_shards(
    docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Shard and gapless slot of each row."""
    narrow = written(sizes(docs, text, doc_id), "sizes")
    ordered = narrow.repartitionByRange(*ORDER)
    ordered = written(ordered.withColumn("_part", F.spark_partition_id()), "ordered")

    # One row per partition: its bytes and rows, and those of all partitions before it.
    totals = ordered.groupBy("_part").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_all_bytes"),
    )

    inside = Window.partitionBy("_part").orderBy(*ORDER)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ordered.select(
        "*",
        F.sum("size").over(running).alias("_bytes_to_here"),
        F.row_number().over(inside).alias("_number"),
    )
    # As many rows as partitions.
    placed = placed.join(F.broadcast(offsets), "_part")
    # A row belongs to the shard that holds its middle byte; doubled, to stay with integers.
    middle = 2 * (F.col("_bytes_before") + F.col("_bytes_to_here")) - F.col("size")
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        (middle * shards).alias("_scaled"),
        (2 * F.col("_all_bytes")).alias("_scale"),
        (F.col("_rows_before") + F.col("_number") - 1).alias("_index"),
    )
    placed = placed.select(
        "doc_id", "size", "text_crc32", "_index", F.expr("int(_scaled div _scale)").alias("shard")
    )
    starts = placed.groupBy("shard").agg(F.min("_index").alias("_start"))
    # As many rows as shards.
    placed = placed.join(F.broadcast(starts), "shard")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_index") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
