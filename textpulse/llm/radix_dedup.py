"""Exact duplicates by most-significant-digit-first radix partitioning over the cluster.

Texts are compared without white space. A group starts as all texts of one length and is
split by their successive bytes, a wider digit every round (64 bytes, then 16 times as far
each time). A group that shrinks to one row is done; a group whose bytes have ended holds
equal texts. Equality rests on the bytes themselves and needs no digest.

Hot groups: the counts per digit are reduced on the map side, so thousands of copies become
one row per task before they move. Rows then learn their group in an equi-join whose hot
partitions Spark splits (adaptive skew join); no window or list ever gathers a group.

Cases: a null text counts as empty, and empty texts are copies of each other. A null id comes
after all others when ties are broken. Rows that are repeated whole are copies: one of them
stays. An empty table gives an empty result. Other columns, whatever their names, are not
touched; ``deduplicate`` returns them as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import WHITE_SPACE, quoted, written

FIRST_DIGIT = 64
GROWTH = 16
TO_THE_END = 2**31 - 1


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _bytes(text: Column) -> Column:
    return text.cast("binary")


def _split(rows: DataFrame, keys: list[str], digit: Column) -> DataFrame:
    """One radix step: rows in a part with others get the part's id, single rows a null."""
    rows = rows.withColumn("_digit", digit)
    parts = rows.groupBy(*keys, "_digit").agg(
        F.count(F.lit(1)).alias("_members"), F.min("_row").alias("_part")
    )
    parts = parts.filter(F.col("_members") > 1).drop("_members")
    return rows.join(parts, [*keys, "_digit"], "left").drop(*keys, "_digit")


def copy_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    keep_rows: bool = False,
    first_digit: int = FIRST_DIGIT,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: id, length, digest of the normalised text and its group.

    ``_group`` is null for texts that occur once. With ``keep_rows`` the whole input row
    comes along as the struct ``_input``. The digest is a report only and decides nothing.
    """
    plain = normalised(quoted(text))
    columns = [
        quoted(doc_id).alias("_id"),
        F.coalesce(F.length(quoted(text)), F.lit(0)).alias("_chars"),
        F.octet_length(plain).alias("_length"),
        F.substring(_bytes(plain), 1, first_digit).alias("_head"),
    ]
    # The text moves once: with whole rows it is a part of them.
    if keep_rows:
        columns.append(F.struct(*[quoted(name) for name in docs.columns]).alias("_input"))
        plain = normalised(F.col("_input").getField(text))
    else:
        columns.append(plain.alias("_plain"))
        plain = F.col("_plain")
    rows = docs.select(*columns)

    # Round zero moves lengths and first digits alone to find the shared ones.
    shared = rows.groupBy("_length", "_head").agg(F.count(F.lit(1)).alias("_members"))
    shared = shared.filter(F.col("_members") > 1)
    rows = rows.join(shared, ["_length", "_head"], "left")
    rest = F.substring(_bytes(plain), first_digit + 1, TO_THE_END)
    rows = rows.withColumn("_rest", F.when(F.col("_members").isNotNull(), rest))
    rows = rows.withColumn("_sha256", F.sha2(plain, 256)).drop("_plain", "_members")
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "radix")

    result = ["_row", "_id", "_chars", "_sha256", *(["_input"] if keep_rows else [])]
    settled = [
        rows.filter(F.col("_rest").isNull()).select(*result, F.lit(None).cast("long").alias("_group"))
    ]
    active = rows.filter(F.col("_rest").isNotNull())
    keys, depth = ["_length", "_head"], first_digit
    while not active.isEmpty():
        width = depth * (growth - 1)
        step = _split(active, keys, F.substring("_rest", 1, width))
        step = step.withColumn("_rest", F.substring("_rest", width + 1, TO_THE_END))
        step = written(step, "radix")
        ended = F.octet_length("_rest") == 0
        alone = F.col("_part").isNull()
        settled.append(step.filter(alone | ended).select(*result, F.col("_part").alias("_group")))
        active = step.filter(~alone & ~ended).withColumnRenamed("_part", "_parent")
        keys, depth = ["_parent"], depth * growth
    labelled = settled[0]
    for part in settled[1:]:
        labelled = labelled.unionByName(part)
    return labelled


def with_winners(labelled: DataFrame) -> DataFrame:
    """Add the row that stays of each group, its id and the group's size.

    The longest original text stays, then the smallest id, then the first of repeated rows.
    """
    rank = F.struct(
        (-F.col("_chars")).alias("chars"),
        F.col("_id").isNull().alias("no_id"),
        F.col("_id").alias("id"),
        F.col("_row").alias("row"),
    )
    grouped = labelled.filter(F.col("_group").isNotNull())
    winners = grouped.groupBy("_group").agg(
        F.min(rank).alias("_best"), F.count(F.lit(1)).alias("_size")
    )
    winners = winners.select(
        "_group",
        F.col("_best.id").alias("_keep_id"),
        F.col("_best.row").alias("_keep_row"),
        "_size",
    )
    grouped = grouped.join(winners, "_group")
    single = labelled.filter(F.col("_group").isNull())
    single = single.withColumns(
        {"_keep_id": F.col("_id"), "_keep_row": F.col("_row"), "_size": F.lit(1).cast("long")}
    )
    rows = single.unionByName(grouped)
    return rows.withColumn("_kept", F.col("_row") == F.col("_keep_row"))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row with the row that stays of its group of equal texts."""
    return with_winners(copy_groups(docs, text, doc_id)).select(
        F.col("_id").alias("doc_id"),
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.col("_sha256").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = with_winners(copy_groups(docs, text, doc_id, keep_rows=True))
    return rows.filter("_kept").select("_input.*")
