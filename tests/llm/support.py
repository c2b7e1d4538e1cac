"""Small tables with the rows that are easy to get wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that operators use inside, as columns of the input.
CLASHING = ("_row", "_id", "_group", "_input", "_key", "_left", "size", "class", "token", "label",
            "bucket", "score", "kept", "_part", "_bin", "a.b")

EDGES = [
    (1, None, "s1"),
    (2, "", "s1"),
    (3, " \t\n", "s1"),
    (4, "one two three", None),
    (5, "one two three", None),
    (5, "one two three", None),
    (6, "onetwo three", "s2"),
    (7, "word " * 3000, "s2"),
    (None, "one two  three", "s2"),
    (9007199254740993, "größe café 漢字 😀 ▁", "s3"),
]


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if clashing:
        docs = docs.withColumns({name: F.lit(name) for name in CLASHING})
    return docs


def collected(df: DataFrame, key: str = "doc_id") -> list:
    return sorted(df.collect(), key=lambda row: (row[key] is None, row[key] or 0, str(row)))
