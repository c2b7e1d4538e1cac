"""Spelling variants against all pairs of small vocabularies."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.support import EDGES, documents
from tests.support import SMALL
from textpulse.llm.spelling_variants import near_counts, spelling_variants
from textpulse.llm.suffix_search import WordIndex, near_words

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts_of(rows, shortest=7, least=2):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            given = "" if doc_id is None else doc_id
            h = zlib.crc32(f"{given}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def neighbours(words):
    """Near words of each word by its own deletions, which equal or meet those of the other."""
    holes = {}
    for word in words:
        for i in range(len(word)):
            holes.setdefault((word[:i], word[i + 1 :]), set()).add(word)
    near = {word: set() for word in words}
    for word in words:
        for i in range(len(word)):
            near[word] |= holes[(word[:i], word[i + 1 :])]
            shorter = word[:i] + word[i + 1 :]
            if shorter in near:
                near[word].add(shorter)
                near[shorter].add(word)
        near[word].discard(word)
    return near


def brute(counts, ratio=10):
    near = neighbours(counts)
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
    result = {}
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        result[word] = (form, root, n, len(near[word]), counts[form] if form else None)
    return result


def collected(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_neighbours_of_the_test_are_those_of_the_definition():
    rng = random.Random(4)
    words = {"".join(rng.choices("ab", k=rng.randint(4, 7))) for _ in range(60)}
    expected = {w: {v for v in words if v != w and one_apart(w, v)} for w in words}
    assert neighbours(words) == expected


@pytest.mark.parametrize("alphabet", ["ab", "abcé", "abcdefghij"])
def test_both_searches_find_all_near_words(alphabet):
    rng = random.Random(len(alphabet))
    words = sorted({"".join(rng.choices(alphabet, k=rng.randint(2, 8))) for _ in range(300)})
    asked = sorted({"".join(rng.choices(alphabet + "z", k=rng.randint(2, 8))) for _ in range(200)})
    asked += words[:50]
    known = set(words)
    halves = [len(w) // 2 for w in asked]
    own = [w in known for w in asked]
    first = near_words(WordIndex(words), asked, halves, own)
    found = {(asked[p], words[m]) for p, m in zip(*first, strict=True)}
    expected = {
        (w, v) for w in asked for v in words
        if w != v and one_apart(w, v) and v.startswith(w[: len(w) // 2])
    }
    assert found == expected
    assert len(first[0]) == len({(p, m) for p, m in zip(*first, strict=True)})
    mirrored = WordIndex([w[::-1] for w in words])
    rest = [len(w) - h for w, h in zip(asked, halves, strict=True)]
    second = near_words(mirrored, [w[::-1] for w in asked], rest, own)
    found |= {(asked[p], words[m]) for p, m in zip(*second, strict=True)}
    assert found == {(w, v) for w in asked for v in words if w != v and one_apart(w, v)}


def test_one_word_and_no_patterns():
    index = WordIndex(["aaaa"])
    pattern, word = near_words(index, ["aaa", "aaaa", "b"], [1, 2, 0], [False, True, False])
    assert (pattern.tolist(), word.tolist()) == ([0], [0])
    assert len(near_words(index, [], [], [])[0]) == 0


def test_whole_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert collected(spelling_variants(docs, words_per_shard=500)) == brute(counts_of(rows))


def test_chains_ties_and_damaged_runs(spark):
    rng = random.Random(1)
    base = ["committee", "comittee", "comitee", "committea", "kommittee", "étudiants", "etudiants",
            "Étudiants", "abcdefgh", "abcdefgi", "ABCDEFG", "abcdef"]
    rows = []
    for i in range(400):
        weights = [300, 30, 3, 3, 3, 50, 5, 1, 20, 20, 2, 9]
        rows.append((rng.choice([i, None]), " ".join(rng.choices(base, weights, k=12)), "s"))
    rows += EDGES
    expected = brute(counts_of([r[:2] for r in rows]))
    assert any(root != form for form, root, *_ in expected.values() if form)
    assert collected(spelling_variants(documents(spark, rows))) == expected


def test_a_half_that_many_words_share_is_cut(spark):
    rng = random.Random(2)
    hot = {"haus" + "".join(rng.choices("abcd", k=rng.randint(4, 5))) for _ in range(700)}
    hot |= {"".join(rng.choices("abcd", k=4)) + "heit" for _ in range(250)}
    counts = {w: 2 + i % 90 for i, w in enumerate(sorted(hot))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").cache()
    found = {r["word"]: r["n_near"] for r in near_counts(words, words_per_shard=60).collect()}
    expected = {w: len(v) for w, v in neighbours(counts).items() if v}
    assert found == expected


def test_long_words_and_empty_tables(spark):
    long = "ab" * 1500
    rows = [(1, f"{long} {long} {long}x {long}x", "s"), (2, None, "s")]
    expected = brute(counts_of([r[:2] for r in rows]))
    assert long in expected
    assert collected(spelling_variants(documents(spark, rows))) == expected
    assert spelling_variants(documents(spark, [])).count() == 0
