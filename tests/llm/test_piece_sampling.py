import itertools
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.support import EDGES, collected, documents
from textpulse.llm import piece_sampling as ps


@pytest.fixture(scope="module")
def vocab():
    return ps.vocabulary(ps.VOCABULARY, ps.SMOOTHING)


def segmentations(vocab, text):
    """All segmentations with their probabilities, by plain recursion."""
    known = {t: n for n, t in enumerate(vocab.text_of) if t and not vocab.is_byte[n]}

    def all_of(rest):
        if not rest:
            yield (), 0.0
            return
        options = [rest[:n] for n in range(1, len(rest) + 1) if rest[:n] in known]
        if rest[0] not in options:
            options.append(None)
        for piece in options:
            if piece is None:
                head, weight = (vocab.size + ord(rest[0]),), vocab.byte_weight * len(rest[0].encode())
                left = rest[1:]
            else:
                head, weight, left = (known[piece],), vocab.weight[known[piece]], rest[len(piece) :]
            for tail, value in all_of(left):
                yield head + tail, value + weight

    found = dict(all_of(" " + text))
    total = sum(map(math.exp, found.values()))
    return {ids: math.exp(v) / total for ids, v in found.items()}


def lattices(vocab, text):
    parts = ps.split_text(text)
    return ps.Lattices(vocab, parts), np.arange(len(parts))


@pytest.mark.parametrize("text", ["abc xy", "été\n a", "  two", "漢x"])
def test_probabilities_equal_enumeration(vocab, text):
    expected = segmentations(vocab, text)
    table, parts = lattices(vocab, text)
    best = tuple(table.best_pieces(parts).tolist())
    assert expected[best] == pytest.approx(max(expected.values()))
    (drawn,) = ps.top_segmentations(table, [parts], 10_000, [1], 1)
    found = {tuple(table.piece[s.edges].tolist()): s for s in drawn}
    assert len(found) == len(drawn) == len(expected)
    for ids, sample in found.items():
        assert math.exp(sample.log_probability) == pytest.approx(expected[ids])
        assert sample.log_inclusion == 0.0
    assert all(a.perturbed >= b.perturbed for a, b in itertools.pairwise(drawn))


def test_sampling_without_replacement(vocab):
    expected = segmentations(vocab, "abc xy")
    table, parts = lattices(vocab, "abc xy")
    runs, firsts, pairs, mass = 4000, Counter(), Counter(), 0.0
    for one, two in ps.top_segmentations(table, [parts] * runs, 2, list(range(runs)), 3):
        a, b = (tuple(table.piece[s.edges].tolist()) for s in (one, two))
        assert a != b
        firsts[a] += 1
        pairs[a, b] += 1
        mass += sum(math.exp(s.log_probability - s.log_inclusion) for s in (one, two)) / runs
    for a, n in firsts.most_common(5):
        assert n / runs == pytest.approx(expected[a], abs=0.03)
    for (a, b), n in pairs.most_common(3):
        chance = expected[a] * expected[b] / (1 - expected[a])
        assert n / runs == pytest.approx(chance, abs=0.03)
    # Probability over inclusion is unbiased for the whole mass, which is 1.
    assert mass == pytest.approx(1, abs=0.05)


def test_samples_depend_on_the_key_alone(vocab):
    texts = ["one text", "", "another one here", "one text", "x"]
    together = [
        [ids.tolist() for ids, _ in e.samples] for e in ps.encode_texts(vocab, texts, [1, 2, 3, 1, 4])
    ]
    for text, key, samples in zip(texts, [1, 2, 3, 1, 4], together, strict=True):
        (alone,) = ps.encode_texts(vocab, [text], [key])
        assert [ids.tolist() for ids, _ in alone.samples] == samples
    assert together[0] == together[3]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_round_trip(text):
    vocab = ps.vocabulary(ps.VOCABULARY, ps.SMOOTHING)
    (found,) = ps.encode_texts(vocab, [text], [0])
    assert vocab.decode(found.ids) == text
    assert all(vocab.decode(ids) == text for ids, _ in found.samples)
    assert len({ids.tobytes() for ids, _ in found.samples}) == len(found.samples) >= 1
    assert found.ids.max(initial=0) < vocab.size


def test_tables(spark):
    docs = documents(spark, EDGES)
    encoded = ps.encode(docs, samples=2)
    rows = collected(encoded)
    assert len(rows) == len(EDGES)
    texts = sorted((str(r.doc_id), r.text) for r in ps.decode(encoded).collect())
    assert texts == sorted((str(i), t or "") for i, t, _ in EDGES)
    assert rows == collected(ps.encode(docs.repartition(3), samples=2))
    report = ps.segmentation_report(docs, samples=2).collect()
    assert all(r.restored for r in report) and len(report) == len(EDGES)
    by_pieces = sorted((str(r.doc_id), len(r.ids)) for r in rows)
    assert by_pieces == sorted((str(r.doc_id), r.n_pieces) for r in report)
    decoded = ps.decode(ps.segmentation_report(docs, samples=2)).collect()
    assert sorted((str(r.doc_id), r.text) for r in decoded) == texts
    for r in report:
        assert len(r.sample_crc32) == r.samples == len(set(zip(r.sample_crc32, r.sample_pieces, strict=True)))
        assert all(v <= 0 for v in r.sample_log_inclusion)
    assert ps.segmentation_report(documents(spark, [])).count() == 0


def test_report_holds_the_sampled_segmentations(spark):
    docs = documents(spark, EDGES)
    report = collected(ps.segmentation_report(docs, samples=2))
    encoded = collected(ps.encode(docs, samples=2))
    assert sorted((str(r.doc_id), [list(ids) for ids in r.sample_ids]) for r in report) == sorted(
        (str(r.doc_id), [list(s.ids) for s in r.samples]) for r in encoded
    )
    vocab = ps.vocabulary(ps.VOCABULARY, ps.SMOOTHING)
    texts = Counter((str(i), t or "") for i, t, _ in EDGES)
    for r in report:
        assert r.samples_restored and len(r.sample_ids) == r.samples >= 1
        assert [len(ids) for ids in r.sample_ids] == r.sample_pieces
        assert all((str(r.doc_id), vocab.decode(np.array(ids, np.int64))) in texts for ids in r.sample_ids)


def test_a_sample_that_does_not_decode_is_told(vocab, spark, monkeypatch):
    wrong = ps.Encoded(np.array([500], np.int32), [(np.array([501], np.int32), ps.Sample(np.empty(0), 0.0, 0.0))])
    right = vocab.decode(wrong.ids)
    monkeypatch.setattr(ps, "encode_texts", lambda *_: iter([wrong]))
    made = {}
    monkeypatch.setattr(ps, "_encoded_rows", lambda *a: made.update(columns=a[4]))
    ps.segmentation_report(documents(spark, []))
    found = made["columns"](vocab, [right], [wrong])
    assert found["restored"].to_pylist() == [True]
    assert found["samples_restored"].to_pylist() == [False]


def test_a_store_that_lets_parts_go_changes_nothing(vocab, monkeypatch):
    texts = [f"the word{n % 7} and x{n} été 漢 of the" for n in range(300)]
    keys = list(range(300))

    def found():
        return [
            (e.ids.tolist(), [(ids.tolist(), s.log_probability, s.log_inclusion) for ids, s in e.samples])
            for e in ps.encode_texts(vocab, texts, keys)
        ]

    expected = found()
    monkeypatch.setattr(ps, "LETTERS_KEPT", 60)
    monkeypatch.setattr(ps, "TEXTS_TOGETHER", 5)
    assert found() == expected


def test_parts_of_many_texts_are_those_of_each():
    texts = ["", "  two  ", "a\n\n b", "x ", " ", "\n", "été 漢\n ñ", "end", "", "end"]
    parts, counts = ps.split_texts(texts)
    assert counts.tolist() == [len(ps.split_text(text)) for text in texts]
    assert parts.to_pylist() == [part for text in texts for part in ps.split_text(text)]
    assert ps.split_texts(["", ""])[1].tolist() == [0, 0]


def test_restored_texts_are_told_in_one_look(vocab, monkeypatch):
    texts = ["one été", "", "漢 x", "two"]
    ids = [e.ids for e in ps.encode_texts(vocab, texts, [0] * 4)]
    broken = np.append(vocab.byte_id[[0xE6]], ids[3]).astype(np.int32)
    others = [*ids[:3], broken]
    assert vocab.restores(others, texts) == [True, True, True, False]
    # Bytes that are no letter are read as a replacement, as decoding does.
    lone = np.concatenate([ids[3], vocab.byte_id[[0xE6]]]).astype(np.int32)
    assert vocab.restores([lone], [vocab.decode(lone)]) == [True]
    monkeypatch.setattr(ps.Vocabulary, "decode", None)
    assert vocab.restores(ids, texts) == [True] * 4
    assert vocab.restores([], []) == []


def test_searches_of_many_texts_go_in_step(vocab, monkeypatch):
    walks = []
    walk = ps.Lattices.walk
    monkeypatch.setattr(ps.Lattices, "walk", lambda self, *a: walks.append(1) or walk(self, *a))
    texts = [f"the word{n} of texts" for n in range(300)]
    assert len(list(ps.encode_texts(vocab, texts, list(range(300))))) == 300
    assert len(walks) == ps.SAMPLES


def test_steps_far_below_change_nothing(vocab, monkeypatch):
    texts = ["the other word was " * 200, "a", "xyz " * 90]

    def found():
        return [
            [(ids.tolist(), s.perturbed, s.log_inclusion) for ids, s in e.samples]
            for e in ps.encode_texts(vocab, texts, [1, 2, 3])
        ]

    expected = found()
    monkeypatch.setattr(ps, "NEAR_STEPS", 10_000)
    assert found() == expected
