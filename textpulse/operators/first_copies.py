"""The first copy of every message of a stream, with work in proportion to each batch.

The keys seen so far are the state of the streaming query: dealt out by hash, kept in the state
store on the executors' disks with the store's own Bloom filters, and uploaded by changes. A
batch looks up the keys that it carries and no others; nothing that was landed is read again.
A key's state is the time and a digest of its first copy, never a text.

This is for rows that leave at once, as messages do: it decides before they go, at the cost of a
call into Python for each key of a batch. Tables need no decision; ``jobs.land_first_seen`` lands
them with built-in expressions alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textpulse.operators.dedup import KEYS

SUPERSEDES = "supersedes"
_ARRIVAL, _DIGEST = "_arrival", "_digest"
# Rows without a time come last: later than any time there is.
_NEVER = 2**63 - 1
_CROSSES_AS_IT_IS = (T.StringType, T.BinaryType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _outward(field: T.StructField) -> Column:
    """A column as text or bytes, which cross to Python and back without loss."""
    column = F.col(field.name)
    if isinstance(field.dataType, _CROSSES_AS_IT_IS):
        return column
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(field.dataType, _NESTED):
        raise ValueError(f"{field.name} is nested; first copies need flat rows")
    return column.cast("string")


def _homeward(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, _CROSSES_AS_IT_IS):
        return column
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(column.cast("bigint")).alias(field.name)
    return column.cast(field.dataType).alias(field.name)


def _order_columns(names: Sequence[str], keys: Sequence[str], arrival: str) -> list[Column]:
    """Copies of a key in their order: by time, and copies of the same time by a digest."""
    others = [name for name in sorted(names) if name not in (*keys, arrival)]
    digest = F.xxhash64(*others) if others else F.lit(0).cast("bigint")
    time = F.coalesce(F.unix_micros(arrival), F.lit(_NEVER))
    return [time.alias(_ARRIVAL), digest.alias(_DIGEST)]


def _first_of_key(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """The key's earliest row of a batch, if it is earlier than what was seen of the key."""
    # Calls into pandas cost more than the few rows of a key: most keys have one row, which goes
    # on as it came.
    best, chosen, at = None, None, 0
    for frame in frames:
        arrivals, digests = frame[_ARRIVAL].tolist(), frame[_DIGEST].tolist()
        for n in range(len(arrivals)):
            place = (int(arrivals[n]), int(digests[n]))
            if best is None or place < best:
                best, chosen, at = place, frame, n
    known = tuple(state.get) if state.exists else None
    if best is None or (known is not None and best >= known):
        return
    state.update(best)
    row = chosen if len(chosen) == 1 else chosen.iloc[at : at + 1]
    yield row if known is None else row.assign(**{SUPERSEDES: "true"})


def first_copies(
    df: DataFrame, keys: Sequence[str] = KEYS, arrival: str = "kafka_timestamp"
) -> DataFrame:
    """Of each key the earliest row of the first batch that has it.

    Should a later batch bring an earlier copy, it comes too, and ``supersedes`` is true; readers
    of a landed table take ``earliest`` of it, so the result does not depend on the order of
    batches. Copies that are no earlier are dropped, for ever; no row is too late. Null keys are
    a key like others. Copies with the same time are told apart by a digest of their columns.
    """
    fields = df.schema.fields
    ordered = df.select(*df.columns, *_order_columns(df.columns, keys, arrival))
    crossing = ordered.select(
        *[_outward(field).alias(field.name) for field in fields],
        F.col(_ARRIVAL).cast("string"),
        F.col(_DIGEST).cast("string"),
        F.lit("false").alias(SUPERSEDES),
    )
    chosen = crossing.groupBy(*keys).applyInPandasWithState(
        _first_of_key,
        crossing.schema,
        "arrival long, digest long",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    superseding = (F.col(SUPERSEDES) == "true").alias(SUPERSEDES)
    return chosen.select(*[_homeward(field) for field in fields], superseding)


def earliest(
    landed: DataFrame, keys: Sequence[str] = KEYS, arrival: str = "kafka_timestamp"
) -> DataFrame:
    """The first copy of each key from landed ``first_copies``, in whatever order they came.

    Only keys with a superseding row have several; they are few, and only these are compared.
    """
    names = [name for name in landed.columns if name != SUPERSEDES]
    several = landed.filter(SUPERSEDES).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    alone = landed.join(several, same, "left_anti").select(*names)
    compared = landed.join(several, same, "left_semi")
    place = F.struct(*_order_columns(names, keys, arrival))
    rest = [name for name in names if name not in keys]
    first = F.min_by(F.struct(*rest), place).alias("_first")
    chosen = compared.groupBy(*keys).agg(first).select(*keys, "_first.*")
    return alone.unionByName(chosen.select(*names))
