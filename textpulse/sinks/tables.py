"""Landing of micro-batches so that a replayed batch does not count twice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.config import PulseConfig


def streaming_query_id(batch: DataFrame) -> str:
    """Id of the running query, which its checkpoint keeps over restarts.

    A replayed batch has the id that it had; a query with a new checkpoint has a new one and
    counts its batches from 0 again.
    """
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or "none"


BATCH_COLUMNS = ("query_id", "batch_id")


def batch_folder(path: str, batch: DataFrame, batch_id: int) -> str:
    return f"{path}/query_id={streaming_query_id(batch)}/batch_id={batch_id}"


def land_in_directory(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that gives every batch its own partition folder and replaces it on replay.

    Folders are named by query and batch, so a lost or new checkpoint adds and never replaces
    what an earlier query has landed.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch, batch_id))

    return land


_KEY_COLUMNS = ("stream_name", "query_id", "batch_id")


@dataclass(frozen=True)
class RelationalTarget:
    """A table reached through JDBC, with a staging table beside it.

    Executors write rows to staging, one connection per partition. The driver then moves
    the batch inside the database in one transaction. ``connect`` returns a PEP 249
    connection to the same database and sees statements only, never rows.

    Column types of the staging table have to be comparable (``text``, not ``clob``).
    ``paramstyle`` is that of the driver module behind ``connect``, one of the five of PEP 249.
    """

    url: str
    table: str
    columns: tuple[str, ...]
    stream: str
    connect: Callable[[], Any] = field(repr=False)
    options: dict[str, str] = field(default_factory=dict, repr=False)
    column_types: str | None = None
    paramstyle: str = "qmark"

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    def jdbc_options(self) -> dict[str, str]:
        options = {**self.options, "url": self.url, "dbtable": self.staging}
        if self.column_types:
            options["createTableColumnTypes"] = self.column_types
        return options

    def staged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch with its origin and a row number.

        A task that is run again numbers its rows the same way, so rows that an executor
        wrote before it was lost can be told from real duplicates.
        """
        return batch.select(
            F.lit(self.stream).alias("stream_name"),
            F.lit(streaming_query_id(batch)).alias("query_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.monotonically_increasing_id().alias("row_number_in_batch"),
            *self.columns,
        )

    def _this_batch(self) -> str:
        markers = {
            "qmark": lambda n, name: "?",
            "format": lambda n, name: "%s",
            "numeric": lambda n, name: f":{n}",
            "named": lambda n, name: f":{name}",
            "pyformat": lambda n, name: f"%({name})s",
        }
        if self.paramstyle not in markers:
            raise ValueError(f"unknown paramstyle {self.paramstyle!r}")
        marker = markers[self.paramstyle]
        tests = [f"{name} = {marker(n, name)}" for n, name in enumerate(_KEY_COLUMNS, 1)]
        return " AND ".join(tests)

    def values(self, query_id: str, batch_id: int) -> tuple | dict:
        """What goes with the statements, by place or by name."""
        values = (self.stream, query_id, batch_id)
        if self.paramstyle in ("named", "pyformat"):
            return dict(zip(_KEY_COLUMNS, values, strict=True))
        return values

    def clear_staging(self) -> str:
        return f"DELETE FROM {self.staging} WHERE {self._this_batch()}"

    def remove_batch(self) -> str:
        return f"DELETE FROM {self.table} WHERE {self._this_batch()}"

    def move_batch(self) -> str:
        columns = ", ".join([*_KEY_COLUMNS, *self.columns])
        return (
            f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM ("
            f"SELECT DISTINCT row_number_in_batch, {columns} FROM {self.staging} "
            f"WHERE {self._this_batch()}) AS batch"
        )


def _write_staging(rows: DataFrame, target: RelationalTarget) -> None:
    rows.write.format("jdbc").options(**target.jdbc_options()).mode("append").save()


def _transaction(target: RelationalTarget, statements: list[str], values: tuple | dict) -> None:
    connection = target.connect()
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement, values)
        connection.commit()
    finally:
        connection.close()


def land_in_database(
    target: RelationalTarget,
    write_staging: Callable[[DataFrame, RelationalTarget], None] = _write_staging,
) -> Callable[[DataFrame, int], None]:
    """A sink that stages a batch and then replaces it in the table in one transaction.

    Whatever an earlier attempt left in staging is removed first. Both tables have to
    exist; ``create_tables`` makes them.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        values = target.values(streaming_query_id(batch), batch_id)
        _transaction(target, [target.clear_staging()], values)
        write_staging(target.staged(batch, batch_id), target)
        moves = [target.remove_batch(), target.move_batch(), target.clear_staging()]
        _transaction(target, moves, values)

    return land


def create_tables(target: RelationalTarget, empty: DataFrame) -> None:
    """Let the JDBC writer create both tables from the schema of an empty frame."""
    staged = target.staged(empty.limit(0), 0)
    _write_staging(staged, target)
    options = {**target.jdbc_options(), "dbtable": target.table}
    final = staged.drop("row_number_in_batch")
    final.write.format("jdbc").options(**options).mode("append").save()


def target_from_config(
    config: PulseConfig,
    stream: str,
    table: str,
    columns: tuple[str, ...],
    connect: Callable[[], Any],
    **options: str,
) -> RelationalTarget:
    if not config.jdbc_url:
        raise ValueError("set jdbc_url")
    login = {"user": config.jdbc_user, "password": config.jdbc_password}
    given = {name: value for name, value in login.items() if value is not None}
    return RelationalTarget(
        url=config.jdbc_url,
        table=table,
        columns=columns,
        stream=stream,
        connect=connect,
        options={**given, **options},
    )
