"""Mine hard negatives: rows of other labels that score a given part below an anchor's positives.

Rows are vectors with an id and a label; their components become whole numbers, and a score is
an inner product, so nothing depends on the order of additions. Anchors are the rows whose id
``ANCHOR_EVERY`` divides; they are a stated query set and grow with the table. They are ordered
by label and direction, cut into blocks of a bounded number, and each block gets its spanning
tree (``anchor_tree``): a row's scores at a child are bounded by its score at the parent, the
edge and its own norm, and only rows whose bounds overlap the child's window are scored.

Blocks go out in rounds of at most ``ROUND_CELLS`` vector components, which is what is
broadcast at a time; rows are never moved. A round passes over the rows for the positives, then,
with their scores known, for the negatives. Each task keeps the best few rows of each anchor or
window, so only these are shuffled. Before each pass the same pass over a small share of the rows
gives scores that an answer has to reach, which bounds windows from below; it leaves out nothing
that could be an answer.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part.
Shorter vectors count as filled up with zeros, an empty vector scores 0 everywhere. Components
beyond 31 bits are taken as the largest that fit; scores have to fit a long. A row with an
anchor's id is not another row, so repeated rows of an anchor are no positives of it; other
repeated rows count one by one, and each row of a repeated anchor gives its own results. A row
without an id is no anchor and comes last among equal scores. An anchor without positives gives
no rows, as does an empty table. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.anchor_tree import AnchorTree, Best, overlapping, pack
from textpulse.llm.common import written

ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 10
# The part of a positive's score that a negative has, in hundredths.
LEAST_PART, MOST_PART = 30, 90

# Anchors of a block at most, components of a block and of a round, rows looked at together.
BLOCK_ANCHORS = 512
BLOCK_CELLS = 2**20
ROUND_CELLS = 2**22
ROWS_AT_ONCE = 2048
# The share of rows that is looked at first.
FIRST_LOOK = 32

_NO_ID = np.iinfo(np.int64).max
_LOWEST = np.iinfo(np.int64).min // 4
_HIGHEST = np.iinfo(np.int64).max // 4
_BLOCKS = "block long, ids array<long>, labels array<long>, width int, cells binary"
_FOUND = "block long, anchor int, slot int, score long, vec_id long"
_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def scored_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, in whole numbers."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("_values"),
    ).filter("label is not null and _values is not null")
    finite = F.forall("_values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    bound = float(2**31 - 1)
    whole = F.transform(
        "_values",
        lambda x: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), x * 256))).cast("int"),
    )
    relabelled = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS)
    return rows.select(
        "vec_id",
        F.coalesce(relabelled, F.col("label")).alias("label"),
        whole.alias("vector"),
    )


def _spread(rows: DataFrame) -> DataFrame:
    """At least a partition for every core, as the work is in the rows and not in their bytes."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _block_maker(width: int, size: int) -> Callable:
    """Rows in their order to blocks of at most ``size``."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        rest: list[pd.DataFrame] = []
        held = 0

        def block(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            number += 1
            cells = pack(rows["vector"].tolist(), width)
            return pd.DataFrame(
                {
                    "block": [number],
                    "ids": [rows["vec_id"].to_numpy(np.int64)],
                    "labels": [rows["label"].to_numpy(np.int64)],
                    "width": [width],
                    "cells": [cells.tobytes()],
                }
            )

        for batch in batches:
            rest.append(batch)
            held += len(batch)
            while held >= size:
                rows = pd.concat(rest, ignore_index=True)
                yield block(rows.iloc[:size])
                rest, held = [rows.iloc[size:]], held - size
        if held:
            yield block(pd.concat(rest, ignore_index=True))

    return make


def anchor_blocks(rows: DataFrame, width: int, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Anchors in blocks of neighbours: by label, then by the signs of their first components."""
    size = max(1, min(block_anchors, BLOCK_CELLS // max(1, width)))
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    signs = F.transform(F.slice("vector", 1, 24), lambda x: F.when(x < 0, "0").otherwise("1"))
    anchors = anchors.withColumn("_signs", F.array_join(signs, ""))
    ordered = anchors.repartitionByRange("label", "_signs", "vec_id")
    ordered = ordered.sortWithinPartitions("label", "_signs", "vec_id")
    return ordered.drop("_signs").mapInPandas(_block_maker(width, size), _BLOCKS)


class _Round:
    """Some blocks of anchors with what each slot looks for; this is what is broadcast."""

    def __init__(self, blocks: list) -> None:
        self.blocks = [block["block"] for block in blocks]
        self.trees = [
            AnchorTree.of(
                np.asarray(block["ids"], np.int64),
                np.asarray(block["labels"], np.int64),
                np.frombuffer(block["cells"], np.int64).reshape(len(block["ids"]), -1),
            )
            for block in blocks
        ]
        # Anchors by slots: the window of each slot, empty where low is above high.
        self.slots = 1
        self.low = [np.full((len(tree.ids), 1), _LOWEST) for tree in self.trees]
        self.high = [np.full((len(tree.ids), 1), _HIGHEST) for tree in self.trees]

    def for_negatives(self, positives: pd.DataFrame) -> None:
        """One slot for each positive: its window of scores."""
        self.slots = POSITIVES
        for at, (block, tree) in enumerate(zip(self.blocks, self.trees, strict=True)):
            low = np.full((len(tree.ids), POSITIVES), _HIGHEST)
            high = np.full((len(tree.ids), POSITIVES), _LOWEST)
            own = positives[positives["block"] == block]
            place = own["anchor"].to_numpy(np.int64), own["place"].to_numpy(np.int64) - 1
            score = own["score"].to_numpy(np.int64)
            low[place] = -((-LEAST_PART * score) // 100)
            high[place] = (MOST_PART * score) // 100
            self.low[at], self.high[at] = low, high

    def raise_low(self, floors: pd.DataFrame) -> None:
        """Scores that answers have to reach, from the best of some rows."""
        for at, block in enumerate(self.blocks):
            own = floors[floors["block"] == block]
            place = own["anchor"].to_numpy(np.int64), own["slot"].to_numpy(np.int64)
            low = self.low[at].copy()
            low[place] = np.maximum(low[place], own["score"].to_numpy(np.int64))
            self.low[at] = low


def _look(
    tree: AnchorTree, rows: tuple, low: np.ndarray, high: np.ndarray, best: Best, same: bool
) -> None:
    """Add the rows that some slot of a block looks for to its best ones."""
    ids, labels, vectors = rows
    count, slots = low.shape
    floors = best.floors(count * slots, low.reshape(-1)).reshape(count, slots)
    # One interval around all windows of an anchor that are not empty.
    open_slot = floors <= high
    least = np.where(open_slot, floors, _HIGHEST).min(axis=1)
    most = np.where(open_slot, high, _LOWEST).max(axis=1)

    def wanted(anchors: np.ndarray) -> np.ndarray:
        equal = tree.labels[anchors][:, None] == labels[None, :]
        if same:
            return equal & (tree.ids[anchors][:, None] != ids[None, :])
        return ~equal

    anchor, row, score, _ = overlapping(tree, vectors, least, most, wanted)
    for slot in range(slots):
        hit = (score >= floors[anchor, slot]) & (score <= high[anchor, slot])
        if hit.any():
            best.add(anchor[hit] * slots + slot, score[hit], ids[row[hit]])


def _looker(shared: Broadcast, width: int, same: bool) -> Callable:
    most = POSITIVES if same else NEGATIVES

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: _Round = shared.value
        best = [Best.empty(most) for _ in given.trees]
        step = max(1, min(ROWS_AT_ONCE, BLOCK_CELLS // max(1, width)))
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                rows = (
                    part["id_or_last"].to_numpy(np.int64),
                    part["label"].to_numpy(np.int64),
                    pack(part["vector"].tolist(), width),
                )
                for tree, low, high, found in zip(
                    given.trees, given.low, given.high, best, strict=True
                ):
                    _look(tree, rows, low, high, found, same)
        for block, found in zip(given.blocks, best, strict=True):
            if len(found.slot):
                yield pd.DataFrame(
                    {
                        "block": block,
                        "anchor": found.slot // given.slots,
                        "slot": found.slot % given.slots,
                        "score": found.score,
                        "vec_id": found.id,
                    }
                )

    return look


def _best_rows(rows: DataFrame, given: _Round, width: int, same: bool) -> DataFrame:
    """The best rows of each slot over all given rows, numbered in ``place``.

    Every task sends its best few of each slot at most, so a slot's group is small.
    """
    shared = rows.sparkSession.sparkContext.broadcast(given)
    part = rows.select(
        F.coalesce("vec_id", F.lit(_NO_ID)).alias("id_or_last"), "label", "vector"
    )
    found = part.mapInPandas(_looker(shared, width, same), _FOUND)
    order = Window.partitionBy("block", "anchor", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= (POSITIVES if same else NEGATIVES))


def _floors(rows: DataFrame, given: _Round, width: int, same: bool) -> pd.DataFrame:
    """The last score of each slot that a share of the rows fills."""
    share = rows.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(FIRST_LOOK)) == 0)
    most = POSITIVES if same else NEGATIVES
    return _best_rows(share, given, width, same).filter(F.col("place") == most).toPandas()


def _mined(rows: DataFrame, blocks: list, width: int) -> DataFrame:
    """The result of one round of blocks."""
    spark = rows.sparkSession
    given = _Round(blocks)
    given.raise_low(_floors(rows, given, width, same=True))
    # Bounded by the round's anchors.
    positives = _best_rows(rows, given, width, same=True).toPandas()
    given.for_negatives(positives)
    given.raise_low(_floors(rows, given, width, same=False))
    negatives = _best_rows(rows, given, width, same=False)
    ids = {block: tree.ids for block, tree in zip(given.blocks, given.trees, strict=True)}
    known = pd.DataFrame(
        {
            "block": positives["block"],
            "anchor": positives["anchor"],
            "slot": positives["place"] - 1,
            "anchor_id": [
                int(ids[block][anchor])
                for block, anchor in zip(positives["block"], positives["anchor"], strict=True)
            ],
            "positive_id": positives["vec_id"],
            "positive_score": positives["score"],
        }
    )
    pairs = spark.createDataFrame(
        list(known.itertuples(index=False, name=None)),
        "block long, anchor int, slot int, anchor_id long, positive_id long, positive_score long",
    )
    joined = negatives.join(F.broadcast(pairs), ["block", "anchor", "slot"])
    without = {
        name: F.when(F.col(name) != _NO_ID, F.col(name)) for name in ("positive_id", "vec_id")
    }
    joined = joined.select(
        "anchor_id",
        without["positive_id"].alias("positive_id"),
        F.col("place").alias("rank"),
        without["vec_id"].alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    return written(joined, "hard-negatives")


def hard_negatives(
    embeddings: DataFrame, *, block_anchors: int = BLOCK_ANCHORS, round_cells: int = ROUND_CELLS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = embeddings.sparkSession
    rows = written(_spread(scored_rows(embeddings)), "scored-rows")
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return spark.createDataFrame([], _RESULT)
    blocks = written(anchor_blocks(rows, width, block_anchors), "anchor-blocks")
    # A number and a size for each block of hundreds of anchors.
    sizes = blocks.select("block", F.size("ids").alias("n")).orderBy("block").collect()
    rounds: list[list[int]] = []
    held = 0
    for row in sizes:
        cells = row["n"] * max(1, width)
        if not rounds or held + cells > round_cells:
            rounds.append([])
            held = 0
        rounds[-1].append(row["block"])
        held += cells
    if not rounds:
        return spark.createDataFrame([], _RESULT)
    parts = []
    for numbers in rounds:
        chosen = blocks.filter(F.col("block").between(numbers[0], numbers[-1]))
        parts.append(_mined(rows, chosen.orderBy("block").collect(), width))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
