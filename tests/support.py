"""Shared by the tests and the oracle check."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd

from textpulse.session import build_session

SMALL = "/root/testdata/sf0.001"


def local_session():
    spark = build_session(
        "textpulse-tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__textpulse__spread=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _kind(series: pd.Series) -> str:
    """Column kinds that have to agree; nulls turn pandas integers into floats or objects."""
    values = series.dropna()
    if pd.api.types.is_bool_dtype(values):
        return "bool"
    if pd.api.types.is_integer_dtype(values):
        return "integer"
    if pd.api.types.is_datetime64_any_dtype(values):
        return "time"
    if pd.api.types.is_float_dtype(values):
        return "integer" if series.isna().any() and (values % 1 == 0).all() else "float"
    return "text"


def _cell(value) -> str:
    if value is None or pd.isna(value):
        return "<null>"
    if isinstance(value, float | np.floating):
        return repr(int(value)) if float(value).is_integer() else repr(float(value))
    if isinstance(value, int | np.integer):
        return repr(int(value))
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in ordered.itertuples(index=False))


def compare(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None if both hold the same columns, kinds and rows; else what differs."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} against {sorted(expected.columns)}"
    if len(actual) and len(actual) == len(expected):
        for name in actual.columns:
            ours, theirs = _kind(actual[name]), _kind(expected[name])
            if ours != theirs and actual[name].notna().any():
                return f"column {name} is {ours}, not {theirs}"
    left, right = rows(actual), rows(expected)
    if left == right:
        return None
    extra = sorted(set(left) - set(right))[:2]
    missing = sorted(set(right) - set(left))[:2]
    return f"{len(left)} rows against {len(right)}; only ours {extra}; only theirs {missing}"
