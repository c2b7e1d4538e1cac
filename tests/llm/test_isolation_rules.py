import random
import re

import numpy as np
import pandas as pd
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.support import EDGES, documents
from textpulse.llm import isolation_rules as rules
from textpulse.llm.training import all_labelled_rows, labelled_rows


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(
        bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:n]
        for n, line in enumerate(lines)
    )
    windows = [tuple(words[n : n + 3]) for n in range(len(words) - 2)]
    covered = {
        n + k for n, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)
    }
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


@given(st.text(alphabet="ab \n\t#é\x0b\x1f 😀", max_size=60))
def test_statistics(text):
    assert rules.text_stats(text)[:5] == brute(text)


def table(spark):
    random.seed(2)
    names = [f"w{n}" for n in range(500)]
    rows, labels = list(EDGES), []
    for n in range(100, 400):
        words = random.choices(names, k=random.randrange(60, 200))
        if n % 6 == 0:
            words = [w + random.choice("#*$") * 3 for w in words]
        rows.append((n, " ".join(words), "s"))
        labels.append((n, int(n % 6 != 0)))
    labels += [(100, 1), (101, None), (None, 1), (5000, 1)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int")


def test_verdicts(spark):
    rows, labels = table(spark)
    found = rules.judge(documents(spark, rows), labels).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, text, _ in rows:
        texts.setdefault(i, []).append(brute(text))
    for r in found:
        stats = tuple(r[name] for name in rules.STATS)
        assert stats in texts[r.doc_id]
        assert r.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and 100 <= r.doc_id < 400:
            assert r.kept == (r.doc_id % 6 != 0)


def test_without_labels_or_rows(spark):
    rows, labels = table(spark)
    none = labels.filter("false")
    found = rules.judge(documents(spark, rows), none).collect()
    assert all(r.kept != r.base_failed for r in found)
    assert rules.judge(documents(spark, []), labels).count() == 0


def test_forest_sets_the_far_point_apart():
    random = np.random.default_rng(1)
    points = random.normal(0.3, 0.02, (500, 3))
    forest = rules.grow_forest(points, np.zeros(3), np.ones(3))
    scores = forest.score(np.vstack([points, [[0.9, 0.3, 0.3]]]))
    assert scores[-1] > scores[:-1].max()
    assert np.allclose(scores, forest.score(np.vstack([points, [[0.9, 0.3, 0.3]]])))


def test_threshold_keeps_the_good():
    scores = np.arange(1000) / 1000
    good = np.ones(1000, bool)
    assert (scores > rules.threshold_for(scores, good, 0.01)).sum() <= 10
    empty = pd.DataFrame({name: pd.Series(dtype="int64") for name in (*rules.STATS, *rules.MORE)})
    assert rules.fit(empty.assign(label=pd.Series(dtype="int64"))) is None


def test_one_row_of_each_labelled_id_is_taken(spark):
    docs = spark.range(100_000).select((F.col("id") % 4).alias("doc_id"), F.col("id").alias("x"))
    labels = spark.createDataFrame([(n, n % 2) for n in range(4)], "doc_id long, quality int")
    rows = labelled_rows(docs, labels, "quality", 10).collect()
    assert sorted((r.doc_id, r.x, r.label) for r in rows) == [(n, n, n % 2) for n in range(4)]


def test_all_labelled_rows_make_the_model(spark):
    """More good rows than any bounded sample had: box, trees and threshold hold all of them."""
    n = 12_000
    texts = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(
            " ",
            F.transform(
                F.sequence(F.lit(1), 50 + F.col("id") % 7),
                lambda k: F.concat(
                    F.lit("w"),
                    k.cast("string"),
                    F.repeat(F.lit("#"), F.pmod(F.hash("id", k), F.lit(2))),
                    F.when(F.col("id") % 40 == 0, "$$$").otherwise(""),
                ),
            ),
        ).alias("text"),
    )
    labels = spark.range(n).selectExpr("id as doc_id", "int(id % 40 != 0) as quality")
    stats = all_labelled_rows(rules.rule_statistics(texts), labels, "quality").toPandas()
    assert len(stats) == n and (stats["label"] == 1).sum() > 10_000
    forest, threshold = rules.fit(stats)
    expected = dict(zip(stats["doc_id"], forest.score(rules.features(stats)), strict=True))
    found = rules.judge(texts, labels).collect()
    assert len(found) == n
    assert all(r.anomaly == expected[r.doc_id] for r in found)
    assert all(r.kept == (not r.base_failed and r.anomaly <= threshold) for r in found)
    lost = sum(r.doc_id % 40 != 0 and not r.kept for r in found)
    assert lost <= rules.GOOD_LOST * n


def test_ranked_value(spark):
    random = np.random.default_rng(3)
    values = np.concatenate([random.normal(size=300), np.full(50, 0.25), [1e-300, -1e9, 1e9]])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3).cache()
    for rank in (0, 1, 170, 200, len(values) - 2, len(values) - 1):
        assert rules.ranked_value(rows, rank, bins=16) == np.sort(values)[rank]


def test_leaves_hold_all_points():
    random = np.random.default_rng(5)
    points = random.uniform(size=(400, 2))
    splits = rules.draw_splits(np.zeros(2), np.ones(2), trees=3, depth=4)
    halves = splits.leaf_counts(points[:150]) + splits.leaf_counts(points[150:])
    assert (halves == splits.leaf_counts(points)).all() and (halves.sum(axis=1) == 400).all()
    one = rules.forest_of(splits, halves)
    other = rules.grow_forest(points, np.zeros(2), np.ones(2), trees=3, depth=4)
    assert (one.score(points) == other.score(points)).all()
