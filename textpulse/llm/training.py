"""Folds, labelled rows and bounded samples of them for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import quoted


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def one_label_each(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) with rows that are null or contradict each other left out."""
    rows = labels.select(quoted(doc_id).alias("doc_id"), quoted(label).cast("int").alias("label"))
    rows = rows.filter("doc_id is not null and label in (0, 1)")
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_max"))
    return rows.filter("label = _max").drop("_max")


def labelled_ids(
    labels: DataFrame, label: str, most_per_class: int, *, folds: int = 1, held_out: int = -1
) -> DataFrame:
    """At most so many ids of each label, those of smallest hash, outside the held-out fold.

    A bounded sample: two top-k selections, whatever the size of the labels.
    """
    rows = one_label_each(labels, label)
    rows = rows.filter(fold(F.col("doc_id"), folds) != held_out)
    rows = rows.withColumn("_order", F.xxhash64("doc_id"))
    parts = [
        rows.filter(F.col("label") == value).orderBy("_order", "doc_id").limit(most_per_class)
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).drop("_order")


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, most_per_class: int, **fold_options
) -> DataFrame:
    """One row of each id of the bounded sample, with its label: the least by its columns.

    Rows of an id are reduced on the map side, so an id with very many rows is no hot spot, and
    there are no more rows than ids.
    """
    ids = labelled_ids(labels, label, most_per_class, **fold_options)
    # Bounded by the sample size.
    rows = docs.join(F.broadcast(ids), "doc_id")
    others = [quoted(name) for name in rows.columns if name not in ("doc_id", "label")]
    least = rows.groupBy("doc_id", "label").agg(F.min(F.struct(*others)).alias("_least"))
    return least.select("doc_id", "_least.*", "label")


def all_labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """One row of each labelled id, with its label: the least by its columns.

    Rows of an id are reduced on the map side before they meet the labels.
    """
    others = [quoted(name) for name in docs.columns if name != "doc_id"]
    least = docs.filter("doc_id is not null").groupBy("doc_id")
    least = least.agg(F.min(F.struct(*others)).alias("_least"))
    rows = least.join(one_label_each(labels, label), "doc_id")
    return rows.select("doc_id", "_least.*", "label")
