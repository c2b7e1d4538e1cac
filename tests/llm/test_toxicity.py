import random

import numpy as np
import pytest

from tests.llm.support import EDGES, documents
from textpulse.llm import toxicity as tox

PLAIN = "the word stupid moron idiot and clown are in a text with others like loser or trash".split()


@pytest.fixture(scope="module")
def decoder():
    return tox.Decoder(tox.language_model(tox.trigram_counts([" ".join(PLAIN)] * 50)))


@pytest.mark.parametrize(
    "written, word",
    [("stupid", "stupid"), ("st*pid", "stupid"), ("m0r0n", "moron"), ("1d1ot", "idiot"),
     ("s.t.u.p.i.d", "stupid"), ("mooooron", "moron"), ("cl0wn!!", "clown"), ("tr@$h", "trash"),
     ("l-o-s-e-r", "loser")],
)
def test_restores_disguised_words(decoder, written, word):
    assert decoder.restore(written) == word


def test_words_of_a_text(decoder):
    assert "idiot" in tox.restored_words("you i d i o t there", decoder)
    assert {"great", "moron"} <= tox.restored_words("Great, MORON!", decoder)
    assert tox.restored_words(" \n ", decoder) == set()


@pytest.mark.parametrize(
    "written, word",
    [("iddiot", "idiot"), ("stuupid", "stupid"), ("sttuuppiidd", "stupid"), ("id iot", "idiot"),
     ("mo ron", "moron"), ("i diot", "idiot"), ("you mo ron!", "moron"), ("st up id", "stupid")],
)
def test_doubled_letters_and_split_words(decoder, written, word):
    assert word in tox.restored_words(written, decoder)


def test_plain_neighbours_stay_apart(decoder):
    text = "the word and the text are in a trash like a clown"
    assert tox.restored_words(text, decoder) == set(text.split())
    assert tox.split_words("id, iot it's id-iot", decoder) == set()


def test_viterbi_equals_search(decoder):
    """The best of all readings, each scored on its own."""

    def readings(token):
        if not token:
            yield "", 0.0
            return
        sign = token[0]
        inner = sign in tox.LOOKS_LIKE
        for rest, cost in readings(token[1:]):
            if sign in tox._NUMBER:
                yield sign + rest, cost
            for letter in tox.LOOKS_LIKE.get(sign, ""):
                yield letter + rest, cost + tox.COST_REPLACED
            if sign not in tox._NUMBER:
                yield rest, cost + (tox.COST_IGNORED if inner else tox.COST_SEPARATOR)

    def value(word, cost):
        a = b = tox.BLANK
        total = -cost
        for n in [*(tox._NUMBER[c] for c in word), tox.BLANK]:
            total += decoder.model[a, b, n]
            a, b = b, n
        return total

    # Inside signs only, and no letter twice in a row, so that readings are these alone.
    for token in ("m0r0n", "id1ot", "cl.wn", "w0rd", "tr4sh", "l0s3r"):
        best = max(value(w, c) for w, c in readings(token))
        assert value(decoder.restore(token), 0) >= best - 6
        assert any(
            w == decoder.restore(token) and abs(value(w, c) - best) < 1e-9 for w, c in readings(token)
        )


def test_trigrams_equal_a_plain_count():
    text = "Abc, abd 1é"
    counts = tox.trigram_counts([text, None]).reshape((tox.SIZE,) * 3)
    assert counts.sum() == len(text) + 1
    assert counts[tox._NUMBER["a"], tox._NUMBER["b"], tox._NUMBER["c"]] == 1


def sample():
    random.seed(6)
    clean = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    rows, labels = [], []
    for n in range(600):
        words = random.choices(clean, k=25)
        toxic = n % 5 == 0
        if toxic:
            words[n % 25] = random.choice(["stupid", "moron", "1diot"[:5].replace("1", "i")])
        rows.append((n, " ".join(words) + f" x{n}", "s"))
        labels.append((n, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = sample()
    docs = documents(spark, rows + EDGES)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer = tox.train(docs, table)
    found = tox.score_documents(docs, scorer).collect()
    assert len(found) == len(rows) + len(EDGES)
    truth = dict(labels)
    held_out = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id > 7]
    assert len(held_out) > 100
    assert all(r.predicted == truth[r.doc_id] for r in held_out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert scorer.score("a m0r0n and st.u.pid") > 0.9 > 0.3 > scorer.score("bal dem fir")


def test_copies_are_no_evidence():
    one = np.unique(np.arange(50, dtype=np.uint32) * 7919)
    other = np.unique(np.arange(50, dtype=np.uint32) * 104729 + 1)
    nearly = np.append(one[:-1], np.uint32(4_000_000_000))
    assert len(tox.distinct_documents([one, nearly, other, one])) == 2


def test_without_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, EDGES)
    assert len({r.score for r in tox.score_documents(docs, tox.train(docs, none)).collect()}) == 1
    empty = documents(spark, [])
    assert tox.score_documents(empty, tox.train(empty, none)).count() == 0
