import random
from collections import Counter, defaultdict

import pytest

from tests.llm.support import EDGES, collected, documents
from textpulse.llm.pareto_mix import MOST_COPIES, mix_documents, mix_rows


def targets(sizes):
    """Share by weight, cap at twice the words, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3.0, 1.0, 2.0)[n % 3] for n, s in enumerate(names)}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weights[s] for s in free)
        above = [s for s in free if left * weights[s] / total > 2 * sizes[s]]
        if not above:
            return {**fixed, **{s: left * weights[s] / total for s in free}}
        for s in above:
            fixed[s] = 2.0 * sizes[s]
        left = 1.5 * sum(sizes.values()) - sum(fixed.values())


def rows_of(n=600):
    random.seed(11)
    sources = ["a", "b", "c", "d", None, "a", "a"]
    return [(i, "w " * random.randrange(1, 60), random.choice(sources)) for i in range(n)]


def test_targets_and_totals(spark):
    rows = rows_of()
    found = mix_documents(documents(spark, rows)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    source_of = {i: s for i, _, s in rows}
    for i, text, source in rows:
        sizes[source] += len(text.split())
    expected = targets(sizes)
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(expected[source])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[source] += r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 5


def test_whole_copies_are_certain(spark):
    found = mix_documents(documents(spark, rows_of())).collect()
    least = defaultdict(lambda: MOST_COPIES)
    for r in found:
        if r["size"]:
            rate = r.target / r.source_size
            assert int(rate + 1e-9) <= r.copies <= MOST_COPIES
            least[r.source_size] = min(least[r.source_size], r.copies)
    assert len(set(least.values())) > 1


def test_reruns_agree_and_rows_are_whole(spark):
    docs = documents(spark, rows_of(200))
    one, other = collected(mix_documents(docs)), collected(mix_documents(docs.repartition(7)))
    assert one == other
    mixed = mix_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert times == Counter({r.doc_id: r.copies for r in one if r.copies})


def test_unequal_weights_inside_a_source(spark):
    docs = documents(spark, [(i, "w " * 10, "a") for i in range(900)], clashing=False)
    docs = docs.unionByName(
        documents(spark, [(i, "w " * 10, "b") for i in range(900, 2700)], clashing=False)
    )
    docs = docs.selectExpr("*", "if(doc_id % 3 = 0, 3.0, 1.0) as w")
    copies = defaultdict(list)
    for r in mix_documents(docs, weight="w").collect():
        if r.doc_id >= 900:
            copies[r.doc_id % 3 == 0].append(r.copies)
    heavy, light = (sum(c) / len(c) for c in (copies[True], copies[False]))
    assert heavy > 1.5 * light


def test_edge_rows_and_empty_table(spark):
    found = mix_documents(documents(spark, EDGES)).collect()
    assert len(found) == len(EDGES)
    assert all(r.taken == 0 for r in found if r["size"] == 0)
    assert mix_documents(documents(spark, [])).count() == 0
    assert mix_rows(documents(spark, [])).count() == 0


def test_whole_rows_are_those_of_the_sample(spark):
    """Also with few bins' worth of rows, repeated and missing ids, and equal ranks at the cuts."""
    random.seed(5)
    ids = [None, *range(150)]
    rows = [
        (random.choice(ids), "w " * random.randrange(0, 9), random.choice("ab")) for _ in range(900)
    ]
    docs = documents(spark, rows).coalesce(1)
    expected = Counter()
    for r in mix_documents(docs).collect():
        if r.copies:
            expected[r.doc_id, r["size"]] += r.copies
    mixed = mix_rows(docs)
    assert Counter((r.doc_id, len(r.text.split())) for r in mixed.collect()) == expected
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and not any("_row#" in x for x in joins)
