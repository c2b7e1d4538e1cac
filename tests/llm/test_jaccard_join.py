import itertools
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.support import EDGES, documents
from textpulse.llm import common
from textpulse.llm import jaccard_join as jj
from textpulse.llm.common import bounded
from textpulse.llm.components import components


def sets_of(rows):
    result = []
    for doc_id, text, _ in rows:
        words = (text or "").encode().lower().split()
        if len(words) >= 5:
            result.append((doc_id, {tuple(words[n : n + 5]) for n in range(len(words) - 4)}))
        else:
            result.append((doc_id, {tuple(words)} if words else set()))
    return result


def brute(rows):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for n, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(n)] = min(doc_id, least.get(find(n), doc_id))
    return sorted(
        (str(i), len(s), str(least.get(find(n)) if s else i)) for n, (i, s) in enumerate(sets)
    )


def check(spark, rows):
    docs = documents(spark, rows).repartition(4)
    found = jj.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(rows)
    return docs


def corpus():
    random.seed(12)
    words = [f"w{n}" for n in range(400)]
    rows, shared = [], random.choices(words, k=40)
    for n in range(25):
        text = random.choices(words, k=random.randrange(5, 90))
        if n % 3 == 0:
            text = shared + text
        rows.append(text)
        for _ in range(random.randrange(6)):
            other = list(text)
            for _ in range(random.randrange(1, 5)):
                other[random.randrange(len(other))] = random.choice(words)
            rows.append(other[random.randrange(3) :])
    # A chain whose ends are not alike, and a group of many near copies.
    base = random.choices(words, k=120)
    for n in range(12):
        rows.append(base[3 * n : 3 * n + 80])
    for n in range(60):
        rows.append([*base[:60], f"x{n}"])
    random.shuffle(rows)
    return [(n, " ".join(text), "s") for n, text in enumerate(rows)]


def test_equals_brute_force(spark):
    docs = check(spark, corpus() + [(1000 + n, *row[1:]) for n, row in enumerate(EDGES)])
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {int(c) for _, _, c in brute(corpus() + [(1000 + n, *r[1:]) for n, r in enumerate(EDGES)])}


def test_one_of_each_with_missing_and_repeated_ids(spark):
    text = " ".join(f"w{n}" for n in range(60))
    rows = [
        (None, text, "a"),
        (None, text + " x", "b"),
        (3, text + " y", "c"),
        (3, text + " y z", "d"),
        (2, "something else entirely that is alone", "e"),
        (4, text + " v", "f"),
        (4, "one clean document under the same id", "g"),
        (None, "near copies none of which has an id at all " + text[:90], "h"),
        (None, "near copies none of which has an id at all " + text[:90] + " q", "h"),
        (None, None, "i"),
        (None, " ", "j"),
    ]
    docs = documents(spark, rows).coalesce(1)
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.source for r in kept.collect()) == ["c", "e", "g", "h", "i", "j"]


def test_edge_rows(spark):
    check(spark, EDGES)


def test_hot_tokens_are_spread(spark, monkeypatch):
    monkeypatch.setattr(jj, "HOT_DOCUMENTS", 3)
    check(spark, corpus()[:60])


def test_long_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_ENTRIES", 4)
    check(spark, corpus())


def test_no_block_holds_a_long_list(spark):
    # One large component, another one, and outsiders of many sizes share a token.
    random.seed(4)
    entries = [(7, n, random.randrange(90, 100), 2, 0) for n in range(900)]
    entries += [(7, n, 95, 1, 1000) for n in range(1000, 1100)]
    entries += [(7, n, random.randrange(40, 200), 3, n) for n in range(2000, 2040)]
    entries += [(8, n, 95, 2, 0) for n in range(500)] + [(8, 2000, 95, 2, 2000)]
    frame = spark.createDataFrame(entries, "token long, class long, size int, place int, component long")
    groups = {}
    for r in jj.list_blocks(frame, 16).collect():
        groups.setdefault(r._bucket, []).append(r)
    assert max(len(rows) for rows in groups.values()) <= 4 * 16
    found = []
    for rows in groups.values():
        assert len({r.token for r in rows}) == 1
        for n, one in enumerate(rows):
            for other in rows[:n]:
                meets = one.side != other.side or one.side == jj.WITHIN
                if meets and one.component != other.component:
                    found.append((one.token, *sorted((one["class"], other["class"]))))
    assert len(found) == len(set(found))
    expected = set()
    for n, (token, name, size, _, component) in enumerate(entries):
        for t, other, its_size, _, its_component in entries[:n]:
            alike = 4 * min(size, its_size) >= 3 * max(size, its_size)
            if t == token and component != its_component and alike:
                expected.add((t, *sorted((name, other))))
    assert expected <= set(found)


def test_empty_table(spark):
    assert jj.near_duplicates(documents(spark, [])).count() == 0
    assert jj.one_of_each(documents(spark, [])).count() == 0


@given(st.lists(st.tuples(st.integers(4, 40), st.integers(0, 9), st.integers(0, 3)), max_size=40),
       st.sampled_from([1, 2, 5, 256]))
def test_list_pairs_equal_all_pairs(entries, block):
    sizes = np.array([e[0] for e in entries], np.int64)
    places = np.minimum(np.array([e[1] for e in entries], np.int64), sizes // 4)
    groups = np.array([e[2] for e in entries], np.int64)
    names = np.arange(len(entries))
    found = {
        frozenset(pair)
        for a, b in jj.list_pairs(names, groups, sizes, places, block)
        for pair in zip(a.tolist(), b.tolist(), strict=True)
    }
    expected = set()
    for i in names:
        for j in names[:i]:
            room = 1 + min(sizes[i] - places[i], sizes[j] - places[j]) - 1
            alike = 4 * min(sizes[i], sizes[j]) >= 3 * max(sizes[i], sizes[j])
            if groups[i] != groups[j] and alike and 7 * room >= 3 * (sizes[i] + sizes[j]):
                expected.add(frozenset((int(i), int(j))))
    assert found == expected


def test_pairs_are_left_to_earlier_lists():
    tokens = np.array([[5, 6, 7]])
    places = np.array([[0, 2, 3]])
    other = np.array([[9, 6, 8]])
    assert not jj.met_before(tokens, places, other, np.array([2]))[0]
    assert jj.met_before(tokens, places, other, np.array([3]))[0]
    assert not jj.met_before(tokens, places, np.array([[1, 2, 3]]), np.array([9]))[0]


def test_derived_overlaps_equal_direct_ones():
    random = np.random.default_rng(3)
    partners = [np.unique(random.integers(0, 300, 80)).astype(np.uint64) for _ in range(5)]
    base = np.unique(random.integers(0, 300, 100)).astype(np.uint64)
    overlaps = jj.Overlaps()
    for _ in range(30):
        base = np.unique(np.append(np.delete(base, random.integers(len(base))), np.uint64(random.integers(300))))
        overlaps.advance(base)
        for n in random.permutation(5)[:4]:
            expected = len(np.intersect1d(base, partners[n]))
            assert overlaps.with_partner(int(n), partners[n]) == expected


def test_sets_of_a_group_are_derived_from_each_other():
    random.seed(5)
    base = np.sort(np.array(random.sample(range(10**6), 200), np.uint64))
    near = [np.sort(np.append(np.delete(base, n), np.uint64(10**7 + n))) for n in range(20)]
    partners = {n: np.sort(np.append(base[n:], np.uint64(10**8 + n))) for n in range(10)}
    overlaps = jj.Overlaps()
    for tokens in near:
        overlaps.advance(tokens)
        for name, partner in partners.items():
            assert overlaps.with_partner(name, partner) == len(set(tokens) & set(partner))
    assert overlaps.derived == (len(near) - 1) * len(partners)


@given(
    st.lists(st.integers(0, 8), min_size=1, max_size=9),
    st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), max_size=30),
)
def test_forest_ties_what_all_pairs_tie(groups, pairs):
    pairs = [(a, b) for a, b in pairs if max(a, b) < len(groups)]
    a, b = (np.array([p[n] for p in pairs], np.int64) for n in (0, 1))
    forest = jj.Forest(np.array(groups))
    ties = forest.tie(a, b)
    labels = forest.labels()
    root = {g: g for g in groups}
    joined = 0
    for one, other in pairs:
        one, other = root[groups[one]], root[groups[other]]
        joined += one != other
        root = {g: one if r == other else r for g, r in root.items()}
    assert ties.sum() == joined < len(set(groups))
    for x, gx in zip(labels.tolist(), groups, strict=True):
        for y, gy in zip(labels.tolist(), groups, strict=True):
            assert (x == y) == (root[gx] == root[gy])


def test_forests_are_no_longer_than_their_entries():
    # A dense group of near copies: all pairs are candidates, a forest of them is offered.
    names = np.arange(600)
    tokens = np.sort(np.random.default_rng(1).integers(0, 2**62, 80).astype(np.uint64))
    group = pd.DataFrame(
        {"token": 7, "class": names, "size": 80, "place": 0, "component": names,
         "side": jj.WITHIN, "bits": [jj.bitmap(tokens)] * 600}
    )
    found = jj._group_pairs(False)(group)
    assert len(found) == 599
    one_of = group.assign(ht=None, hp=None)
    assert len(jj._group_pairs(True)(one_of)) == 600 * 599 // 2


def test_bitmaps_never_hide_similar_sets():
    random = np.random.default_rng(6)
    sets = []
    for size in (1, 3, 40, 64, 65, 300, 380):
        base = random.integers(0, 2**63, size).astype(np.uint64)
        for lost in (0, 1, size // 8, size // 4, size // 2):
            more = random.integers(0, 2**63, lost // 2).astype(np.uint64)
            sets.append(np.unique(np.append(base[lost:], more)))
    sets = [s for s in sets if len(s)]
    pairs = [(a, b) for a in sets for b in sets]
    lengths = np.array([(len(a), len(b)) for a, b in pairs])
    passed = jj.nearly_similar(
        [jj.bitmap(a) for a, _ in pairs], [jj.bitmap(b) for _, b in pairs], *lengths.T
    )
    similar = np.array([len(np.intersect1d(a, b)) >= jj.least_overlap(len(a), len(b)) for a, b in pairs])
    assert passed[similar].all()
    sized = 4 * lengths.min(axis=1) >= 3 * lengths.max(axis=1)
    assert passed[sized & ~similar].mean() < 0.3


def test_shingles_alone_and_together():
    texts = ["a b c d e f g", "A  b\tC d e", None, "", "x y", "é ü ö ä ß", "y x", "b c d e f"]
    together = jj.many_shingles(texts)
    assert [len(s) for s in together] == [3, 1, 0, 0, 1, 1, 1, 1]
    assert all((jj.shingles(t) == s).all() for t, s in zip(texts, together, strict=True))
    assert together[1][0] in together[0] and together[7][0] in together[0]
    assert together[4][0] != together[6][0]


def test_prefixes_of_similar_sets_meet():
    random = np.random.default_rng(5)
    order = jj.Order(random.integers(0, 50, jj.COUNTERS))
    for _ in range(200):
        one = np.unique(random.integers(0, 2**62, 40)).astype(np.uint64)
        other = np.unique(np.append(one[random.integers(0, 6) :], random.integers(0, 2**62, 3).astype(np.uint64)))
        shared = len(np.intersect1d(one, other))
        if shared >= jj.least_overlap(len(one), len(other)):
            assert len(np.intersect1d(order.prefix(one), order.prefix(other)))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(-50, 50), random.randrange(-50, 50)) for _ in range(60)]
    edges += [(n, n + 1) for n in range(100, 140)] + [(500, n) for n in range(501, 560)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(frame).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: find(n) for n in linked}
    assert components(frame.limit(0)).count() == 0


def test_pieces_of_a_batch_are_bounded():
    texts = ["a b c d e f", None, "", "x" * 50, "q", "r s", "t", "u"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    pieces = [p["text"].to_pylist() for p in bounded(iter([batch, batch.slice(0, 0)]), 12, 3)]
    assert sum(pieces, []) == texts
    assert all(len(p) <= 3 for p in pieces)
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 12 for p in pieces)


def test_no_worker_holds_a_whole_batch_of_texts():
    """A task gives its results as it goes, not one frame for all texts of a batch."""
    texts = [f"text number {n} of the batch with words " * 40 for n in range(5000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    order = jj.Order(np.zeros(jj.COUNTERS, np.int64))
    posted = list(jj._post(order, 2, 5)(iter([batch])))
    assert len(posted) >= 2 and all(b.num_rows <= 2 for b in posted)
    described = list(jj._describe(5, ())(iter([batch])))
    assert max(b.num_rows for b in described) <= jj.ROWS_HELD
    assert sum(b.num_rows for b in described[:-1]) == len(texts)


@pytest.mark.parametrize("seed", range(5))
def test_entries_with_a_partner_are_those_in_pairs(seed):
    random = np.random.default_rng(seed)
    n = 60 * seed
    token, group = random.integers(0, 6, n), random.integers(0, 5, n)
    size = random.integers(1, 60, n).astype(np.int32)
    place = (size * random.random(n) * 0.35).astype(np.int32)
    order = np.lexsort((size, token))
    token, group, size, place = token[order], group[order], size[order], place[order]
    expected = np.zeros(n, bool)
    for name in np.unique(token):
        rows = np.flatnonzero(token == name)
        for i, j in jj.list_pairs(rows, group[rows], size[rows], place[rows], block=4):
            expected[i] = expected[j] = True
    assert (jj.has_partner(token, group, size, place) == expected).all()


def test_only_the_result_stays_on_disk(spark, tmp_path, monkeypatch):
    words = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join(words[n % 4 : 50 + n % 3]), None) for n in range(40)]
    number = itertools.count()
    monkeypatch.setattr(
        common, "scratch_dir", lambda spark, purpose: str(tmp_path / f"{purpose}-{next(number)}")
    )
    check(spark, rows)
    assert [path.name.split("-")[0] for path in tmp_path.iterdir()] == ["joined"]


def test_sets_are_read_where_they_lie():
    sets = [np.arange(n, dtype="<u8") * 7 for n in (3, 0, 5, 1)]
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([s.tobytes() for s in sets], kind)
        for begin in (0, 1, 2):
            found = jj._sets_in(column.slice(begin))
            assert [f.tolist() for f in found] == [s.tolist() for s in sets[begin:]]
