"""Toxicity of texts whose words may be disguised.

A noisy channel explains how a plain word became what is written: letters replaced by look-alike
digits and signs, letters repeated, separators put in, spaces between letters or pieces. Viterbi
decoding over the lattice of possible letters, under a character language model counted over the
whole corpus, restores the likeliest word. Neighbouring short pieces are one word if the model
finds it likelier than the pieces apart. Words and word beginnings found to mark toxic documents
then score the restored text; a word that is only read into a text stands beside what is written.

Cases: a null or blank text has no words and gets the base score. Very long texts are read
whole. Repeated rows each get a result. Without labels of both kinds no word is evidence and
every text gets the same score. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import map_with_id, quoted, written
from textpulse.llm.training import fold, labelled_rows, one_label_each

FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.3
MOST_LABELLED = 3_000
MOST_FEATURES = 2_000
CHARS_AT_ONCE = 4_000_000

# Alphabet of the language model: a class for white space and signs, and one for each letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäãåæçèéêëìíîïñòóôöõøœùúûüýÿß"
BLANK = 0
SIZE = 64
_CLASS = np.full(0x180, SIZE - 1, np.uint8)
_CLASS[:0xC0] = BLANK
for _n, _c in enumerate(LETTERS, 1):
    _CLASS[ord(_c)] = _n
    if len(_c.upper()) == 1 and ord(_c.upper()) < len(_CLASS):
        _CLASS[ord(_c.upper())] = _n
_NUMBER = {c: n for n, c in enumerate(LETTERS, 1)}

# Signs that stand for letters.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i",
    "*": "aeiou", "#": "aeiou",
}
SEPARATORS = "*.-_~^'`+=/\\:,;#%&|!?\"()[]{}<>"
EDGE_SIGNS = "*.-_~^'`+=/\\:,;#%&|!?\"()[]{}<>$@"
COST_REPLACED = 1.5
COST_REPEATED = 1.0
COST_SEPARATOR = 1.0
# A sign or digit inside a word that could be a letter, and is left out nevertheless.
COST_IGNORED = 5.0
# A word is spelled out if so many single characters follow each other.
LEAST_SPELLED = 3
# Pieces of a split word have so many letters, and words so many pieces, at most.
LONGEST_PIECE = 4
MOST_PIECES = 3


def trigram_counts(texts: Iterable[str | None]) -> np.ndarray:
    """Counts of letter trigrams, flat, SIZE cubed."""
    total = np.zeros(SIZE**3, np.int64)
    piece: list[str] = []
    size = 0

    def count() -> None:
        codes = np.frombuffer(" ".join(["", *piece, ""]).encode("utf-32-le"), np.uint32)
        kinds = _CLASS[np.minimum(codes, len(_CLASS) - 1)].astype(np.int64)
        if len(kinds) > 2:
            grams = (kinds[:-2] * SIZE + kinds[1:-1]) * SIZE + kinds[2:]
            total[:] += np.bincount(grams, minlength=SIZE**3)

    for text in texts:
        piece.append(text or "")
        size += len(text or "")
        if size >= CHARS_AT_ONCE:
            count()
            piece, size = [], 0
    count()
    return total


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter after two others, with bigrams and letters mixed in."""
    cube = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    three = cube / np.maximum(cube.sum(axis=2, keepdims=True), 1)
    pair = cube.sum(axis=0)
    two = pair / np.maximum(pair.sum(axis=1, keepdims=True), 1)
    one = (pair.sum(axis=0) + 1) / (pair.sum() + SIZE)
    return np.log(0.9 * three + 0.08 * two[None] + 0.02 * one[None, None])


@dataclass
class Decoder:
    """Restores words; remembers what it has decoded, up to a bound."""

    model: np.ndarray
    memory: dict[str, str] = field(default_factory=dict)
    most: int = 200_000

    def __getstate__(self):
        return {"model": self.model, "memory": {}, "most": self.most}

    def restore(self, token: str) -> str:
        found = self.memory.get(token)
        if found is None:
            if len(self.memory) >= self.most:
                self.memory.clear()
            found = self.memory[token] = self._viterbi(token)
        return found

    def joined(self, pieces: str) -> str:
        """The word that pieces make together; empty if they are likelier as they stand."""
        found = self.memory.get(pieces)
        if found is None:
            apart = pieces.split()
            word = "".join(apart)
            cost = COST_SEPARATOR * (len(apart) - 1)
            better = self.likelihood(word) - cost > sum(map(self.likelihood, apart))
            if len(self.memory) >= self.most:
                self.memory.clear()
            found = self.memory[pieces] = word if better else ""
        return found

    def likelihood(self, word: str) -> float:
        """Log probability of a plain word between blanks."""
        numbers = [BLANK, BLANK, *(_NUMBER[letter] for letter in word), BLANK]
        return float(sum(self.model[tuple(numbers[n : n + 3])] for n in range(len(word) + 1)))

    def _viterbi(self, token: str) -> str:
        """The likeliest plain word; states are the last two letters kept."""
        states: dict[tuple[int, int], tuple[float, str]] = {(BLANK, BLANK): (0.0, "")}
        inner = range(len(token) - len(token.lstrip(EDGE_SIGNS)), len(token.rstrip(EDGE_SIGNS)))
        for place, sign in enumerate(token):
            options = [(sign, 0.0)] if sign in _NUMBER else []
            skip = COST_IGNORED if sign in LOOKS_LIKE and place in inner else COST_SEPARATOR
            options += [(letter, COST_REPLACED) for letter in LOOKS_LIKE.get(sign, "")]
            after: dict[tuple[int, int], tuple[float, str]] = {}

            def offer(state: tuple[int, int], value: float, word: str) -> None:
                if state not in after or value > after[state][0]:
                    after[state] = (value, word)

            for (a, b), (value, word) in states.items():
                for letter, cost in options:
                    n = _NUMBER[letter]
                    offer((b, n), value + self.model[a, b, n] - cost, word + letter)
                    if n == b:
                        offer((a, b), value - COST_REPEATED, word)
                if sign not in _NUMBER:
                    offer((a, b), value - skip, word)
            states = after
        best = max(
            ((value + self.model[a, b, BLANK], word) for (a, b), (value, word) in states.items()),
            default=(0.0, ""),
        )
        return best[1]


_MULTIPLIERS = [2 * n * n * 7919 + 1 for n in range(1, 13)]

_PLAIN = re.compile(f"[{LETTERS}]+")
_TWICE = re.compile(r"(.)\1")
# Short words side by side, with no signs between them.
_PIECES = re.compile(
    r"(?<![^\s\"(\[*])[%s]{1,%d}(?:[ \t\n\x0b\x0c\r]+[%s]{1,%d}(?![^\s.,;:!?\")\]*]))+"
    % (LETTERS, LONGEST_PIECE, LETTERS, LONGEST_PIECE)
)
_SPELLED = re.compile(
    r"(?<!\S)\S(?:[ \t\n\x0b\x0c\r]+\S(?!\S)){%d,}" % (LEAST_SPELLED - 1)
)


def token_words(token: str, decoder: Decoder) -> list[str]:
    """What a lower-cased token may say: itself, and restored if it looks disguised."""
    bare = token.strip(EDGE_SIGNS)
    if not bare:
        return []
    words = []
    if _PLAIN.fullmatch(bare):
        words.append(bare)
        if _TWICE.search(bare):
            words.append(decoder.restore(bare))
        if bare == token or (token[0] not in "@$|!" and token[-1] not in "@$|!"):
            return words
        token = token.strip(".,;:?\"'()")
    if any(c in _NUMBER for c in token):
        words.append(decoder.restore(token))
    return [word for word in words if word]


def spelled_out(lowered: str, decoder: Decoder) -> list[str]:
    """Words whose letters stand apart."""
    return [decoder.restore("".join(run.split())) for run in _SPELLED.findall(lowered)]


def split_words(lowered: str, decoder: Decoder, wanted: Container[str] | None = None) -> set[str]:
    """Words that stand in pieces; of those only the ones with wanted evidence, if it is given."""
    windows = set()
    for run in _PIECES.findall(lowered):
        pieces = run.split()
        for size in range(2, MOST_PIECES + 1):
            for n in range(len(pieces) - size + 1):
                word = "".join(pieces[n : n + size])
                if wanted is None or word in wanted or (
                    word[:4] + "-" in wanted or word[:5] + "-" in wanted or word[:6] + "-" in wanted
                ):
                    windows.add(" ".join(pieces[n : n + size]))
    return set(map(decoder.joined, windows)) - {""}


def restored_words(text: str, decoder: Decoder) -> set[str]:
    """The distinct words of a text, lower-cased, with disguised ones restored."""
    lowered = text.lower()
    words = set(spelled_out(lowered, decoder)) | split_words(lowered, decoder)
    for token in set(lowered.split()):
        words.update(token_words(token, decoder))
    words.discard("")
    return words


def evidence(words: Iterable[str]) -> set[str]:
    """Words and their beginnings; a beginning ends in a dash."""
    found = set(words)
    for word in list(found):
        found.update(word[:n] + "-" for n in (4, 5, 6) if len(word) >= n)
    return found


def evidence_codes(words: Iterable[str]) -> np.ndarray:
    """Evidence as sorted 32-bit codes; compact enough to compare thousands of documents."""
    found = evidence(words)
    codes = np.fromiter((zlib.crc32(f.encode()) for f in found), np.uint32, len(found))
    return np.unique(codes)


@dataclass(frozen=True)
class Lexicon:
    """Chance that a document with the feature is toxic, and that of one without any."""

    chance: dict[str, float]
    base: float

    def score(self, features: set[str]) -> float:
        clean = 1.0 - self.base
        for feature in sorted(features & self.chance.keys()):
            clean *= 1.0 - self.chance[feature]
        return 1.0 - clean


@dataclass
class Scorer:
    """Scores texts; remembers tokens that are no evidence, up to a bound."""

    decoder: Decoder
    lexicon: Lexicon
    innocent: set[str] = field(default_factory=set)
    most: int = 300_000

    def __getstate__(self):
        return {"decoder": self.decoder, "lexicon": self.lexicon, "innocent": set(), "most": self.most}

    def score(self, text: str | None) -> float:
        lowered = (text or "").lower()
        apart = spelled_out(lowered, self.decoder)
        apart += split_words(lowered, self.decoder, self.lexicon.chance)
        features = evidence(apart) & self.lexicon.chance.keys()
        for token in set(lowered.split()) - self.innocent:
            found = evidence(token_words(token, self.decoder)) & self.lexicon.chance.keys()
            features |= found
            if not found:
                if len(self.innocent) >= self.most:
                    self.innocent.clear()
                self.innocent.add(token)
        return self.lexicon.score(features)


def distinct_documents(documents: list[np.ndarray], alike: float = 0.5) -> list[np.ndarray]:
    """Without documents much like an earlier one, so that copies are no evidence.

    Two documents are compared if they agree in one of four triples of smallest hashes.
    """
    seen: dict[tuple[int, ...], list[np.ndarray]] = {}
    kept = []
    for codes in documents:
        if not len(codes):
            continue
        wide = codes.astype(np.uint64)
        least = [int(((wide * m + 12345) % 4294967291).min()) for m in _MULTIPLIERS]
        bands = [(n, *least[n : n + 3]) for n in range(0, 12, 3)]
        others = (other for band in bands for other in seen.get(band, ()))
        if any(_alike(codes, other) >= alike for other in others):
            continue
        kept.append(codes)
        for band in bands:
            seen.setdefault(band, []).append(codes)
    return kept


def _alike(left: np.ndarray, right: np.ndarray) -> float:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared)


@dataclass(frozen=True)
class Marks:
    """Chances of the chosen features by their codes, and of a document without any."""

    chance: dict[int, float]
    base: float

    def named(self, features: Iterable[str]) -> Lexicon:
        names = {f: zlib.crc32(f.encode()) for f in features}
        return Lexicon({f: self.chance[c] for f, c in names.items() if c in self.chance}, self.base)


def choose_evidence(
    toxic: list[np.ndarray],
    clean: list[np.ndarray],
    toxic_total: int,
    clean_total: int,
    least_documents: int = 3,
    least_surprise: float = 10.0,
    least_chance: float = 0.95,
    most: int = MOST_FEATURES,
) -> Marks:
    """Features that mark toxic documents, by their chances in the whole labelled set.

    Both lists hold the features of different documents of a balanced sample. A feature's
    lean to toxic documents must be no accident: ``least_surprise`` bounds the log of how
    much likelier its counts are with its own chance than with that of any other word.
    """
    nothing = np.empty(0, np.uint32)
    codes, inside = np.unique(np.concatenate([nothing, *toxic]), return_counts=True)
    known = inside >= least_documents
    codes, inside = codes[known], inside[known].astype(float)
    others, counts = np.unique(np.concatenate([nothing, *clean]), return_counts=True)
    outside = np.zeros(len(codes))
    _, here, there = np.intersect1d(codes, others, return_indices=True)
    outside[here] = counts[there]

    toxic_weight = toxic_total / max(len(toxic), 1)
    clean_weight = clean_total / max(len(clean), 1)
    marked = inside * toxic_weight
    chance = marked / np.maximum(marked + (outside + 0.1) * clean_weight, 1e-9)
    share = len(toxic) / max(len(toxic) + len(clean), 1)
    n = inside + outside
    surprise = inside * np.log(inside / (n * share)) if len(n) else inside
    some = outside > 0
    surprise[some] += outside[some] * np.log(outside[some] / (n[some] * (1 - share)))
    strong = np.flatnonzero((surprise >= least_surprise) & (chance >= least_chance))
    strong = strong[np.argsort(-inside[strong], kind="stable")][:most]
    chosen = codes[strong]
    left = sum(not np.isin(d, chosen).any() for d in toxic) * toxic_weight
    chances = dict(zip(chosen.tolist(), chance[strong].tolist(), strict=True))
    return Marks(chances, (left + 0.5) / (left + clean_total + 1))


def corpus_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The language model of all texts; SIZE cubed numbers, whatever the corpus."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            total += trigram_counts(batch["text"])
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"gram": seen, "n": total[seen]})

    rows = docs.select(quoted(text).alias("text"))
    grams = rows.mapInPandas(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = grams.toPandas()
    counts = np.zeros(SIZE**3, np.int64)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return language_model(counts)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    most_labelled: int = MOST_LABELLED,
) -> Scorer:
    """Language model of the corpus, and evidence from a bounded sample of labelled rows.

    At most ``most_labelled`` documents of each label outside the held-out fold take part.
    """
    decoder = Decoder(corpus_model(docs, text))
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    sample_folds = {"folds": FOLDS, "held_out": HELD_OUT}
    rows = labelled_rows(rows, labels, label, most_labelled, **sample_folds)
    rows = written(rows.select("label", "text").distinct(), "toxic-sample")

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [
                evidence_codes(restored_words(text or "", decoder)).astype("<u4").tobytes()
                for text in batch["text"]
            ]
            yield pd.DataFrame({"label": batch["label"], "codes": codes})

    sample = rows.mapInPandas(coded, "label int, codes binary").toPandas()
    sample = sample.sort_values(["label", "codes"])
    by_label = [
        distinct_documents(
            [np.frombuffer(c, "<u4") for c in sample["codes"][sample["label"] == value]]
        )
        for value in (0, 1)
    ]
    totals = one_label_each(labels, label).filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    n_toxic, n_all = totals.agg(F.sum("label"), F.count("label")).first()
    n_toxic = n_toxic or 0
    marks = choose_evidence(by_label[1], by_label[0], n_toxic, n_all - n_toxic)

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: set[str] = set()
            for text in batch["text"]:
                found.update(marks.named(evidence(restored_words(text or "", decoder))).chance)
            yield pd.DataFrame({"feature": sorted(found)}, dtype="object")

    toxic_rows = rows.filter("label = 1").select("text")
    named = toxic_rows.mapInPandas(names, "feature string").distinct().toPandas()
    return Scorer(decoder, marks.named(sorted(named["feature"])))


def score_documents(
    docs: DataFrame,
    scorer: Scorer,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Id, fold and score of each row."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.fromiter(map(scorer.score, batch["text"]), float, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    result = map_with_id(rows, scored, "score double")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return result.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
