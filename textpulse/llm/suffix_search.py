"""A bidirectional suffix-rank index over a delimited list of words, searched for near words.

The words of a list are written one after the other, each with a delimiter before it, as one
circular text. The index ranks the rotations of this text and of its mirror image. A pattern
is an interval of ranks in both, and may grow by a letter on either side.

``near_words`` follows a search scheme for one error: a pattern's first part is matched
without error, from its end back to the delimiter before it; then the pattern is extended to
the right, over its other part and the delimiter behind it, with exactly one error. The scheme
for the other part is the same on mirrored words. All patterns of a list are searched at once:
every step takes one letter further in all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# Sorts before every letter and is none.
DELIMITER = "\0"
# A letter of a pattern that the index does not have.
ABSENT = -1


def _rotations(symbols: np.ndarray, kinds: int) -> np.ndarray:
    """The starts of all rotations in their order: many letters at once, then doubling."""
    n = len(symbols)
    bits = max(1, int(kinds - 1).bit_length())
    known = min(60 // bits, n)
    keys = np.zeros(n, np.int64)
    for ahead in range(known):
        keys = (keys << bits) | np.roll(symbols, -ahead)
    while True:
        order = np.argsort(keys)
        ordered = keys[order]
        ranks = np.empty(n, np.int64)
        ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        # Words are distinct, so no two rotations are equal.
        if ranks[order[-1]] == n - 1:
            return order
        keys = ranks * n + np.roll(ranks, -known)
        known *= 2


@dataclass(frozen=True)
class _Ranks:
    """Letters before each rotation: how many of each kind there are up to a rank."""

    counts: np.ndarray  # ranks + 1, letters
    starts: np.ndarray  # first rank of the rotations that start with a letter

    @classmethod
    def of(cls, symbols: np.ndarray, order: np.ndarray, kinds: int) -> _Ranks:
        before = symbols[order - 1]
        counts = np.zeros((len(symbols) + 1, kinds), np.int32)
        counts[np.arange(1, len(symbols) + 1), before] = 1
        np.cumsum(counts, axis=0, out=counts)
        return cls(counts, np.concatenate([[0], np.cumsum(counts[-1])[:-1]]))

    def children(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval and letter before it: letters up to the interval, and inside."""
        first = self.counts[low]
        return first, self.counts[low + size] - first


class WordIndex:
    """The index of distinct words, none of them empty."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = list(words)
        text = "".join(DELIMITER + word for word in self.words)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        self.letters, symbols = np.unique(codes, return_inverse=True)
        symbols = symbols.astype(np.int64)
        kinds = len(self.letters)
        order = _rotations(symbols, kinds)
        self.left = _Ranks.of(symbols, order, kinds)
        mirror = symbols[::-1].copy()
        self.right = _Ranks.of(mirror, _rotations(mirror, kinds), kinds)
        self.length = len(symbols)
        # The word that a rotation starts in; the delimiter belongs to the word behind it.
        self.word_of_rank = (np.cumsum(symbols == 0) - 1)[order]

    def symbols(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of words one after the other, each word followed by a delimiter; starts."""
        text = "".join(word + DELIMITER for word in words)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        found = np.searchsorted(self.letters, codes)
        found[found == len(self.letters)] = 0
        symbols = np.where(self.letters[found] == codes, found, ABSENT)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return symbols, np.cumsum(lengths) - lengths


@dataclass
class _States:
    """Partly matched patterns: which, the next letter's place, and the interval."""

    pattern: np.ndarray
    place: np.ndarray
    low: np.ndarray
    mirror: np.ndarray
    size: np.ndarray

    def at(self, chosen: np.ndarray) -> _States:
        return _States(*(getattr(self, name)[chosen] for name in _FIELDS))

    @classmethod
    def joined(cls, parts: Sequence[_States]) -> _States:
        return cls(*(np.concatenate([getattr(p, name) for p in parts]) for name in _FIELDS))


_FIELDS = ("pattern", "place", "low", "mirror", "size")


def _to_left(index: WordIndex, states: _States, letter: np.ndarray) -> _States:
    """The states with a letter more on the left; those without a match are gone."""
    known = np.flatnonzero(letter != ABSENT)
    states, letter = states.at(known), letter[known]
    first, inside = index.left.children(states.low, states.size)
    rows = np.arange(len(letter))
    smaller = np.cumsum(inside, axis=1)[rows, letter] - inside[rows, letter]
    grown = _States(
        states.pattern,
        states.place,
        index.left.starts[letter] + first[rows, letter],
        states.mirror + smaller,
        inside[rows, letter].astype(np.int64),
    )
    return grown.at(np.flatnonzero(grown.size))


def _children(
    index: WordIndex, states: _States, rows: np.ndarray, letter: np.ndarray, kids: tuple
) -> _States:
    """The chosen states, each with the chosen letter more on the right."""
    first, inside, smaller = kids
    return _States(
        states.pattern[rows],
        states.place[rows],
        states.low[rows] + smaller[rows, letter],
        index.right.starts[letter] + first[rows, letter],
        inside[rows, letter].astype(np.int64),
    )


def _kids(index: WordIndex, states: _States) -> tuple:
    first, inside = index.right.children(states.mirror, states.size)
    return first, inside, np.cumsum(inside, axis=1) - inside


def _next_letter(
    index: WordIndex, states: _States, letter: np.ndarray, kids: tuple
) -> _States:
    """The states that match their pattern's next letter, one place further."""
    rows = np.flatnonzero(letter != ABSENT)
    rows = rows[kids[1][rows, letter[rows]] > 0]
    grown = _children(index, states, rows, letter[rows], kids)
    grown.place = grown.place + 1
    return grown


def _one_error(
    states: _States, index: WordIndex, letter: np.ndarray, after: np.ndarray, kids: tuple
) -> _States:
    """What the states become by one error at their place.

    Of errors that give the same word only the last place counts: another letter before an
    equal one, or one of equal letters left out.
    """
    at_end = letter == 0
    other = kids[1] > 0
    other[:, 0] = False
    known = np.flatnonzero(letter != ABSENT)
    other[known, letter[known]] = False
    rows, letters = np.nonzero(other)
    inserted = _children(index, states, rows, letters, kids)
    replaced = inserted.at(np.flatnonzero(~at_end[rows]))
    replaced.place = replaced.place + 1
    left_out = states.at(np.flatnonzero(~at_end & (letter != after)))
    left_out.place = left_out.place + 1
    return _States.joined([inserted, replaced, left_out])


def near_words(
    index: WordIndex, patterns: Sequence[str], exact: Sequence[int], own: Sequence[bool]
) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word) numbers of words that share a pattern's first letters and differ once.

    ``exact`` gives how many letters of each pattern have to match, ``own`` whether the pattern
    is itself a word of the index. Both number arrays have the same length; pairs are distinct.
    """
    none = np.zeros(0, np.int64)
    if not patterns or not index.words:
        return none, none
    symbols, starts = index.symbols(patterns)
    exact = np.asarray(exact, np.int64)
    own = np.asarray(own, np.int64)
    count = len(patterns)
    states = _States(
        np.arange(count),
        starts + exact - 1,
        np.zeros(count, np.int64),
        np.zeros(count, np.int64),
        np.full(count, index.length),
    )
    # Back from the end of the first part to the delimiter before the pattern.
    ready = []
    while len(states.pattern):
        done = states.place < starts[states.pattern]
        if done.any():
            ended = states.at(np.flatnonzero(done))
            ready.append(_to_left(index, ended, np.zeros(len(ended.pattern), np.int64)))
            states = states.at(np.flatnonzero(~done))
            continue
        states = _to_left(index, states, symbols[states.place])
        # Where only the pattern itself is left there is nothing to find.
        states = states.at(np.flatnonzero(states.size > own[states.pattern]))
        states.place = states.place - 1
    if not ready:
        return none, none
    # To the right: states without an error, and states that have had theirs.
    clean = _States.joined(ready)
    clean.place = starts[clean.pattern] + exact[clean.pattern]
    clean = clean.at(np.flatnonzero(clean.size > own[clean.pattern]))
    erred = clean.at(none)
    found = []
    while len(clean.pattern) or len(erred.pattern):
        if len(erred.pattern):
            letter = symbols[erred.place]
            matched = _next_letter(index, erred, letter, _kids(index, erred))
            over = symbols[matched.place - 1] == 0
            if over.any():
                found.append(matched.at(np.flatnonzero(over)))
                matched = matched.at(np.flatnonzero(~over))
            erred = matched
        if len(clean.pattern):
            letter = symbols[clean.place]
            after = symbols[np.minimum(clean.place + 1, len(symbols) - 1)]
            # Two letters that the index lacks need not be equal; the later place is tried too.
            after = np.where(letter == ABSENT, ABSENT - 1, after)
            kids = _kids(index, clean)
            erred = _States.joined([erred, _one_error(clean, index, letter, after, kids)])
            going = np.flatnonzero(letter != 0)
            clean = _next_letter(
                index, clean.at(going), letter[going], tuple(k[going] for k in kids)
            )
            clean = clean.at(np.flatnonzero(clean.size > own[clean.pattern]))
    if not found:
        return none, none
    matches = _States.joined(found)
    pairs = np.unique(
        matches.pattern * len(index.words) + index.word_of_rank[matches.low]
    )
    return pairs // len(index.words), pairs % len(index.words)
