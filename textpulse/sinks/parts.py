"""Tables that are sums of mergeable parts: a part for each batch, merged level by level.

A manifest names the parts that count. Every change is a new manifest with the next number,
renamed into place, so a reader sees the table as it was at one moment and two writers cannot
both be next. As soon as a level has ``fanout`` parts, they become one part of the next level,
so that there are at most ``fanout`` parts a level and as many levels as the logarithm of the
batches. Parts that were merged stay for ``grace`` seconds for readers that still use them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from textpulse.sinks.folders import SharedFolder
from textpulse.sinks.tables import streaming_query_id

Merge = Callable[[DataFrame], DataFrame]

FANOUT = 8
GRACE = 3600.0
# Old manifests are of no use but to see what happened.
MANIFESTS_KEPT = 20


@dataclass(frozen=True)
class Manifest:
    """What a table consists of at one moment.

    ``parts`` maps folders to levels, ``batches`` each query to the last batch that is in,
    ``merged`` folders that no longer count to the time since when. ``notes`` is for whoever
    lands the batches: what a query wrote down with its last batch.
    """

    number: int = 0
    parts: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    merged: dict[str, float] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        return cls(**json.loads(text))


class PartTable:
    """A table of parts below a folder, added up by ``merge``.

    ``merge`` turns any rows of parts into fewer rows that mean the same, with the same columns.
    Batches of one query have to come in the order of their numbers, as those of a streaming
    query do; a batch that is in already, because it is replayed, is left out.
    """

    def __init__(
        self, spark: SparkSession, path: str, merge: Merge, *, fanout: int = FANOUT, grace: float = GRACE
    ) -> None:
        if fanout < 2:
            raise ValueError("a level needs room for two parts")
        self.spark, self.path, self.merge = spark, path, merge
        self.fanout, self.grace = fanout, grace
        self._root = SharedFolder(spark, path)
        self._manifests = SharedFolder(spark, f"{path}/_manifest")

    def manifest(self) -> Manifest:
        """The newest manifest."""
        while True:
            names = [name for name in self._manifests.names() if name[0].isdigit()]
            if not names:
                return Manifest()
            text = self._manifests.read(names[-1])
            # Another writer may have gone on and tidied up in between.
            if text is not None:
                return Manifest.from_json(text)

    def _commit(self, change: Callable[[Manifest], Manifest | None]) -> Manifest | None:
        """Apply a change to the newest manifest; again, if another writer was faster."""
        while True:
            before = self.manifest()
            after = change(before)
            if after is None:
                return None
            after = replace(after, number=before.number + 1)
            if self._manifests.put_new(f"{after.number:012d}.json", after.to_json()):
                return after

    def land(self, part: DataFrame, batch_id: int, query_id: str, note: dict | None = None) -> bool:
        """Add the part of a batch, and merge what has to be merged; False for a replay."""
        if self.manifest().batches.get(query_id, -1) >= batch_id:
            return False
        folder = f"query_id={query_id}/batch_id={batch_id}"
        # What an earlier attempt left here was never part of the table.
        part.write.mode("overwrite").parquet(f"{self.path}/{folder}")

        def add(now: Manifest) -> Manifest | None:
            if now.batches.get(query_id, -1) >= batch_id:
                return None
            return replace(
                now,
                parts={**now.parts, folder: 0},
                batches={**now.batches, query_id: batch_id},
                notes=now.notes if note is None else {**now.notes, query_id: note},
            )

        landed = self._commit(add) is not None
        self._merge_levels()
        self._tidy()
        return landed

    def sink(self, parts_of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """A sink for the batches of a stream, each reduced to its part."""

        def land(batch: DataFrame, batch_id: int) -> None:
            self.land(parts_of(batch), batch_id, streaming_query_id(batch))

        return land

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{folder}" for folder in folders])

    def read(self) -> DataFrame | None:
        """The rows of all parts, to be merged by the reader; None while there is no part."""
        folders = list(self.manifest().parts)
        return self._rows(folders) if folders else None

    def _merge_levels(self) -> None:
        while True:
            now = self.manifest()
            full = next(
                (
                    level
                    for level in sorted(set(now.parts.values()))
                    if list(now.parts.values()).count(level) >= self.fanout
                ),
                None,
            )
            if full is None:
                return
            chosen = [name for name, level in now.parts.items() if level == full][: self.fanout]
            folder = f"_levels/{full + 1}-{uuid.uuid4().hex}"
            self.merge(self._rows(chosen)).write.parquet(f"{self.path}/{folder}")

            def swap(
                now: Manifest, chosen=tuple(chosen), folder=folder, level=full + 1
            ) -> Manifest | None:
                if not all(name in now.parts for name in chosen):
                    return None
                kept = {name: at for name, at in now.parts.items() if name not in chosen}
                gone = {name: time.time() for name in chosen}
                return replace(now, parts={**kept, folder: level}, merged={**now.merged, **gone})

            if self._commit(swap) is None:
                # Another writer has merged them; this merge was never part of the table.
                self._root.delete(folder)

    def _tidy(self) -> None:
        """Remove parts that were merged long ago, and old manifests."""
        now = self.manifest()
        old = [name for name, since in now.merged.items() if time.time() - since >= self.grace]
        if old:
            self._commit(
                lambda m: replace(m, merged={k: v for k, v in m.merged.items() if k not in old})
            )
            for name in old:
                self._root.delete(name)
        names = [name for name in self._manifests.names() if name[0].isdigit()]
        for name in names[:-MANIFESTS_KEPT]:
            self._manifests.delete(name)
