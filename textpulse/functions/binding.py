"""Naming a value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` uses it.

    A plain reuse of ``value`` repeats its expression, and Spark shares repeated expressions
    only outside of conditional branches. A lambda's argument is a variable.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
