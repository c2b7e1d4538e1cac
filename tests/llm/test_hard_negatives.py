"""Hard negatives against all scores of small tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.support import CLASHING
from tests.support import SMALL
from textpulse.llm.anchor_tree import AnchorTree, Best, overlapping, products
from textpulse.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    taking = []
    for vec_id, vector, label in rows:
        if label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taking.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    width = max((len(v) for _, _, v in taking), default=0)
    taking = [(i, label, v + [0] * (width - len(v))) for i, label, v in taking]
    result = []

    def order(pair):
        return (-pair[0], pair[1] is None, pair[1] or 0)

    for anchor, label, vector in taking:
        if anchor is None or anchor % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, v, strict=True)), i, other)
            for i, other, v in taking
        ]
        same = sorted((s for s in scored if s[2] == label and s[1] != anchor), key=order)[:5]
        for positive_score, positive, _ in same:
            fitting = [
                s for s in scored
                if s[2] != label and 30 * positive_score <= 100 * s[0] <= 90 * positive_score
            ]
            for rank, (score, negative, _) in enumerate(sorted(fitting, key=order)[:10], 1):
                result.append((anchor, positive, rank, negative, positive_score, score))
    return result


def check(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(n) for n in CLASHING if n != "label"})
    found = [tuple(r) for r in hard_negatives(table.repartition(3), **options).collect()]
    expected = brute(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(found, key=key) == sorted(expected, key=key)
    return expected


def clustered(rng, count, width, centers):
    points = rng.normal(size=(centers, width))
    vectors = points[rng.integers(centers, size=count)] + 0.05 * rng.normal(size=(count, width))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors


def test_all_scores_of_a_small_table(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(900, 6)).round(2)
    labels = rng.integers(0, 3, size=900)
    rows = [(int(i), v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]
    assert check(spark, rows, block_anchors=4, round_cells=40)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        vector = [[1.0, 0.5], [0.5, 1.0], [0.3, 0.3], [-1.0, 0.0], [0.0, 0.0]][int(rng.integers(5))]
        rows.append((i, vector, int(rng.integers(0, 2))))
    rows += rows[95:205]
    rows += [
        (None, [1.0, 0.5], 0), (None, [0.4, 0.4], 1), (100000, None, 1), (100100, [1.0, 0.5], None),
        (100200, [1.0, None], 1), (100300, [1.0, math.nan], 1), (100400, [math.inf, 1.0], 1),
        (100500, [], 1), (100600, [0.7], 1), (100700, [0.7, 0.1, 0.9], 0), (-100, [1.0, 1.0], 0),
    ]
    assert check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, None, None)]])
def test_no_answers(spark, rows):
    assert check(spark, rows) == []


def test_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    found = sorted(tuple(r) for r in hard_negatives(table).collect())
    assert found == sorted(brute(rows)) and found


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(3)
    rows = np.floor(256 * clustered(rng, 4000, 16, 8)).astype(np.int64)
    anchors = np.floor(256 * clustered(np.random.default_rng(3), 200, 16, 8)).astype(np.int64)
    tree = AnchorTree.of(np.arange(200), np.zeros(200, np.int64), anchors)
    scores = products(anchors, rows)
    floor = np.sort(scores, axis=1)[:, -10]
    anchor, row, score, scored = overlapping(tree, rows, floor, np.full(200, 2**40))
    expected = {(a, r) for a, r in zip(*np.nonzero(scores >= floor[:, None]), strict=True)}
    assert set(zip(anchor.tolist(), row.tolist(), strict=True)) == expected
    assert np.array_equal(scores[anchor, row], score)
    assert scored < 0.4 * scores.size


def test_tree_is_a_least_spanning_tree():
    rng = np.random.default_rng(5)
    points = rng.integers(-50, 50, size=(40, 3))
    tree = AnchorTree.of(np.arange(40), np.zeros(40, np.int64), points)
    assert sum(len(level) for level in tree.levels) == 40 and (tree.parent < 0).sum() == 1
    joined, total = {0}, 0.0
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    while len(joined) < 40:
        length, node = min(
            (apart[a, b], b) for a in joined for b in range(40) if b not in joined
        )
        joined.add(node)
        total += length
    assert tree.edge[tree.parent >= 0].sum() == pytest.approx(total, rel=1e-6)


def test_best_keeps_ties_by_id():
    best = Best.empty(2)
    best.add(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 3, 4]))
    best.add(np.array([0, 1]), np.array([5, 2]), np.array([1, 8]))
    assert list(zip(best.slot, best.score, best.id, strict=True)) == [
        (0, 5, 1), (0, 5, 3), (1, 2, 8), (1, 1, 4)
    ]
    assert best.floors(2, np.array([0, 0])).tolist() == [5, 1]


def test_wide_numbers_stay_exact():
    big = np.array([[2**31 - 1, 2**31 - 1]], np.int64)
    assert products(big, big)[0, 0] == 2 * (2**31 - 1) ** 2
