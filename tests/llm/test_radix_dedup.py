import random
import re
from collections import defaultdict

import pytest

from tests.llm.support import EDGES, collected, documents
from textpulse.llm import radix_dedup
from textpulse.llm.common import written
from textpulse.llm.radix_dedup import copy_groups, deduplicate, exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for n, (doc_id, text, _) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        order = (-len(text or ""), doc_id is None, doc_id or 0, n)
        groups[body].append((order, doc_id))
    result = []
    for body, members in groups.items():
        best = min(members)
        for member in members:
            result.append((member[1], best[1], len(members), body))
    return sorted(result, key=str)


def check(spark, rows):
    docs = documents(spark, rows)
    found = exact_duplicates(docs).collect()
    import hashlib

    expected = brute(rows)
    ours = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    theirs = [(i, k, n, hashlib.sha256(b.encode()).hexdigest()) for i, k, n, b in expected]
    assert sorted(ours, key=str) == sorted(theirs, key=str)
    bodies = {r.text_sha256 for r in found}
    assert sum(r.kept for r in found) == len(bodies)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    return docs


def test_edge_rows(spark):
    docs = check(spark, EDGES)
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(brute(EDGES)) - 5


def test_digits_of_growing_width(spark):
    random.seed(5)
    rows, stem = [], "abcdefgh" * 400
    for n in range(60):
        at = random.choice([3, 63, 64, 65, 1023, 1024, 2000, 3199])
        text = stem[:at] + random.choice("xyz") + stem[at:]
        rows.append((n, text[:100] + " " * random.randrange(3) + text[100:], None))
    check(spark, rows)
    small = copy_groups(documents(spark, rows), first_digit=2, growth=2)
    groups = {(r["_sha256"], r["_group"]) for r in small.collect() if r["_group"] is not None}
    assert len({g for _, g in groups}) == len(groups) == len({s for s, _ in groups})


@pytest.mark.parametrize("operator", [exact_duplicates, deduplicate])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def test_order_of_input_does_not_matter(spark):
    rows = [(n % 7, f"text {n % 3}" + " " * (n % 2), None) for n in range(21)]
    one = collected(exact_duplicates(documents(spark, rows)))
    other = collected(exact_duplicates(documents(spark, rows[::-1]).repartition(5)))
    assert one == other


def test_texts_move_once_with_whole_rows(spark):
    """The plan of the first round holds the text in the row alone, not beside it as well."""
    docs = documents(spark, [(n, f"text {n % 3}", "s") for n in range(30)])
    plans = []

    def noted(df, purpose):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, purpose)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(radix_dedup, "written", noted)
        assert len(deduplicate(docs).collect()) == 3
    assert "_input#" in plans[0] and "_plain#" not in plans[0]
