"""Helper for costly columns that are filtered on and then kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters read as they are.

    The optimizer pushes a filter below the projection that computes its input and repeats
    the expression there, so parsing or cleaning with a filter on the result would run
    twice per row. It does not push filters into a generator. ``inline`` over an array of
    one struct yields exactly one row per row, stays in whole-stage codegen, and moves no
    data.
    """
    added = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(added)))
