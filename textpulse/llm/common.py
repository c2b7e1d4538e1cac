"""What several operators share: words, sizes and tables in the shared folder."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.session import drop_folder, scratch_dir

# Fixed value: the white space of the contracts, which is ASCII only.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed value: without it shuffle files stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders of written tables, and the tables of the function that writes them.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_open_tables: ContextVar[list[DataFrame] | None] = ContextVar("open_tables", default=None)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has run."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts lineage so that a lost executor costs its own tasks only, and fixes whatever a
    second evaluation could change, such as row numbers. What was shuffled for it goes at
    once, the folder when the session ends or the table is dropped.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    _note(table)
    return table


def _note(table: DataFrame) -> None:
    tables = _open_tables.get()
    if tables is not None:
        tables.append(table)


def drop_written(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for table in tables:
        drop_folder(table.sparkSession, _folders.pop(table))


def result_only(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions that return a written table: others written on the way go at the end."""

    @functools.wraps(function)
    def tidied(*args, **named) -> DataFrame:
        tables: list[DataFrame] = []
        token = _open_tables.set(tables)
        try:
            result = function(*args, **named)
        finally:
            _open_tables.reset(token)
        if result not in _folders:
            raise ValueError(f"{function.__name__} returns no written table")
        drop_written(*[table for table in tables if table is not result and table in _folders])
        _note(result)
        return result

    return tidied


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text; null and blank texts have none.

    Every word but those at the very ends has white space on both sides, so words are counted
    as their first characters: a character that is no white space after one that is.
    """
    spaced = F.concat(F.lit(" "), F.coalesce(text, F.lit("")))
    return F.regexp_count(spaced, F.lit(r"[\x20\x09-\x0D][^\x20\x09-\x0D]")).cast("long")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bounded(
    batches: Iterator[pa.RecordBatch], characters: int, most_rows: int, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """The rows of some batches in pieces of so many characters, and so many rows, at most.

    One longer text goes alone.
    """
    for batch in batches:
        begin, size = 0, 0
        lengths = pc.fill_null(pc.utf8_length(batch[text]), 0).to_pylist()
        for end, length in enumerate(lengths):
            if end > begin and (size + length > characters or end - begin == most_rows):
                yield batch.slice(begin, end - begin)
                begin, size = end, 0
            size += length
        if begin < len(lengths):
            yield batch.slice(begin)


def map_with_id(
    rows: DataFrame,
    function: Callable,
    columns: str,
    names: tuple[str, ...] = ("doc_id",),
    arrow: bool = False,
) -> DataFrame:
    """``mapInPandas``, or ``mapInArrow``, for rows with ids: they cross as text.

    Whole numbers with nulls would become floating-point numbers in pandas, and long ids
    would be rounded.
    """
    kinds = {name: rows.schema[name].dataType for name in names}
    as_text = rows.withColumns({name: F.col(name).cast("string") for name in names})
    head = ", ".join(f"{name} string" for name in names)
    through = as_text.mapInArrow if arrow else as_text.mapInPandas
    found = through(function, f"{head}, {columns}")
    return found.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})
