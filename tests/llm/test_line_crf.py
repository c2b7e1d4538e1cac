import itertools
import random

import numpy as np
import pytest

from tests.llm.support import EDGES, documents
from textpulse.llm import line_crf as crf


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(4)
    counts = np.array([1, 3, 2, 5])
    table = draw.normal(size=(counts.sum(), 4))
    field = crf.Field(draw.normal(size=4), draw.normal(size=(2, 2)))
    pairs = np.zeros((2, 2))
    found = field.marginals(table, counts, pairs)
    expected, expected_pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        energy = table[at : at + n] @ field.unary
        at += n
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            value = sum(e for e, y in zip(energy, labels, strict=True) if y)
            value += sum(field.transition[a, b] for a, b in itertools.pairwise(labels))
            weights[labels] = np.exp(value)
        total = sum(weights.values())
        for k in range(n):
            expected.append(sum(w for y, w in weights.items() if y[k]) / total)
        for y, w in weights.items():
            for a, b in itertools.pairwise(y):
                expected_pairs[a, b] += w / total
    assert np.allclose(found, expected)
    assert np.allclose(pairs, expected_pairs)


def test_neighbours_stay_inside_their_document():
    lines = crf.line_features(["a b\nc!! d", "E F G"])
    wide = crf.with_neighbours(lines)
    own = crf.OWN
    assert (lines.counts == [2, 1]).all()
    assert (wide[0, own : 2 * own] == 0).all() and (wide[1, 2 * own : 3 * own] == 0).all()
    assert np.allclose(wide[0, 2 * own : 3 * own], lines.features[1])
    assert (wide[2, own : 3 * own] == 0).all()


def sample():
    random.seed(9)
    words = [f"w{n}" for n in range(300)]
    rows, labels = [], []
    for n in range(300):
        lines = [" ".join(random.choices(words, k=12)) for _ in range(random.randrange(1, 6))]
        good = n % 4 != 0
        if not good:
            lines = [line.replace(" ", "!! ").upper() for line in lines]
        rows.append((n, "\n".join(lines), "s"))
        labels.append((n, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = sample()
    docs = documents(spark, rows + EDGES)
    table = spark.createDataFrame(labels + [(0, 1), (7, None)], "doc_id long, quality int")
    field = crf.train(docs, table)
    found = crf.score_documents(docs, field).collect()
    assert len(found) == len(rows) + len(EDGES)
    truth = dict(labels)
    held_out = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id > 7]
    assert len(held_out) > 30
    assert all(r.predicted == truth[r.doc_id] for r in held_out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    kept = crf.accepted(docs, field)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.predicted for r in found)


def test_long_and_batched_texts_score_alike():
    rows, labels = sample()
    texts = [t for _, t, _ in rows]
    field = crf.fit_field(texts[:100], np.array([y for _, y in labels[:100]]), steps=30)
    whole = crf.score_texts(field, texts)
    assert np.allclose(whole, [crf.score_texts(field, [t])[0] for t in texts])
    assert len(crf.score_texts(field, ["line of words\n" * 5000, None, ""])) == 3


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None)]])
def test_without_both_labels(spark, labels):
    docs = documents(spark, EDGES)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    found = crf.score_documents(docs, crf.train(docs, table)).collect()
    assert {r.score for r in found} == {0.5}


def test_empty_table(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    field = crf.train(docs, labels)
    assert crf.score_documents(docs, field).count() == 0
    assert crf.accepted(docs, field).count() == 0
