"""Bounds on inner products along a spanning tree of anchors.

A block of anchors is joined by its least spanning tree. For a row r, an anchor c and its
parent p in the tree, ``<c, r>`` is within ``|c - p| |r|`` of ``<p, r>``. So an interval that
holds a row's score at the parent, widened by edge times norm, holds its score at the child.
Only the root scores every row; every other anchor scores the rows whose interval overlaps what
it looks for, and passes the intervals on, narrow where it has scored and widened elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

# Rounding of distances, norms and products must never make an interval too narrow.
SLACK = 1e-9
# Above this share of overlapping rows one product of matrices is cheaper than single scores.
DENSE = 0.05


def pack(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones are filled up with zeros."""
    matrix = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(matrix, vectors, strict=True):
        row[: len(vector)] = vector
    return matrix


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles while they fit, else in integers."""
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if largest * anchors.shape[1] < 2.0**53:
        return np.rint(anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return anchors @ rows.T


@dataclass(frozen=True)
class AnchorTree:
    """A block of anchors with its spanning tree, parents before children, level by level."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[np.ndarray]
    parent: np.ndarray
    edge: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> AnchorTree:
        """Grow the least spanning tree from the anchor nearest to the block's mean."""
        points = vectors.astype(np.float64)
        count = len(points)
        squares = (points**2).sum(axis=1)
        center = points.mean(axis=0)
        root = int(((points - center) ** 2).sum(axis=1).argmin())
        parent = np.full(count, -1)
        depth = np.zeros(count, np.int64)
        nearest = np.full(count, np.inf)
        inside = np.zeros(count, bool)
        node = root
        for _ in range(count):
            inside[node] = True
            if parent[node] >= 0:
                depth[node] = depth[parent[node]] + 1
            apart = squares + squares[node] - 2 * (points @ points[node])
            closer = ~inside & (apart < nearest)
            parent[closer] = node
            nearest[closer] = apart[closer]
            node = int(np.where(inside, np.inf, nearest).argmin())
        # Distances themselves are taken from differences, which lose no digits.
        joined = np.where(parent >= 0, parent, root)
        edge = np.sqrt(((points - points[joined]) ** 2).sum(axis=1)) * (1 + SLACK)
        edge = edge + np.sqrt(squares[joined]) * SLACK
        levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
        return cls(ids, labels, vectors, levels, parent, edge)


def overlapping(
    tree: AnchorTree,
    rows: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    wanted: Callable[[np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor, row, score) of scored pairs whose score is in the anchor's window, and how many
    pairs were scored.

    ``low`` and ``high`` are the windows, both ends included. ``wanted`` tells for some anchors
    which rows they look at, as a mask of anchors by rows.
    """
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
    shape = (len(tree.ids), len(rows))
    least, most = np.empty(shape), np.empty(shape)
    found: list[tuple[np.ndarray, ...]] = []
    scored = 0
    for level, anchors in enumerate(tree.levels):
        if level:
            reach = tree.edge[anchors][:, None] * norms + 0.5
            least[anchors] = least[tree.parent[anchors]] - reach
            most[anchors] = most[tree.parent[anchors]] + reach
            look = most[anchors] >= low[anchors][:, None]
            look &= least[anchors] <= high[anchors][:, None]
            if wanted is not None:
                look &= wanted(anchors)
        else:
            # The root scores every row, wanted or not: its children's intervals start here.
            look = np.ones((len(anchors), len(rows)), bool)
        pairs = int(look.sum())
        scored += pairs
        if pairs > DENSE * look.size:
            every = products(tree.vectors[anchors], rows)
            scores = every[look]
            at, row = np.nonzero(look)
        else:
            at, row = np.nonzero(look)
            scores = _single_products(tree.vectors[anchors], rows, at, row)
        anchor = anchors[at]
        least[anchor, row] = scores
        most[anchor, row] = scores
        hit = (scores >= low[anchor]) & (scores <= high[anchor])
        if not level and wanted is not None:
            hit &= wanted(anchors)[at, row]
        found.append((anchor[hit], row[hit], scores[hit]))
    return (*(np.concatenate(part) for part in zip(*found, strict=True)), scored)


def _single_products(
    anchors: np.ndarray, rows: np.ndarray, at: np.ndarray, row: np.ndarray
) -> np.ndarray:
    """Inner products of chosen pairs, so many at once that they stay small."""
    step = max(1, 2**20 // max(1, anchors.shape[1]))
    parts = [
        np.einsum("ij,ij->i", anchors[at[i : i + step]], rows[row[i : i + step]])
        for i in range(0, len(at), step)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


@dataclass
class Best:
    """The best (score, id) pairs of each slot, by score downwards and then id."""

    most: int
    slot: np.ndarray
    score: np.ndarray
    id: np.ndarray

    @classmethod
    def empty(cls, most: int) -> Best:
        return cls(most, *(np.zeros(0, np.int64) for _ in range(3)))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot = np.concatenate([self.slot, slot])
        score = np.concatenate([self.score, score])
        ids = np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])[: len(slot)])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = order[rank < self.most]
        self.slot, self.score, self.id = slot[rank < self.most], score[kept], ids[kept]

    def floors(self, slots: int, start: np.ndarray) -> np.ndarray:
        """The score that a further pair of each slot has to reach, ``start`` at least."""
        floors = start.copy()
        count = np.bincount(self.slot, minlength=slots) if len(self.slot) else np.zeros(slots, int)
        full = count[:slots] >= self.most
        if full.any():
            last = np.full(slots, np.iinfo(np.int64).max)
            np.minimum.at(last, self.slot, self.score)
            floors[full] = np.maximum(floors[full], last[full])
        return floors
