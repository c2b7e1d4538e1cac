"""Encoding into pieces, decoding, and distinct sampled segmentations of every text.

A text is cut where no piece can reach across: before the spaces that begin a word and around
line breaks. Every part has a lattice of pieces, and a segmentation of the text is one path
through each. Its probability follows the ranks of its pieces (Zipf's law, smoothed), normalised
by a backward pass, so the mass of any region of segmentations is known exactly.

Sampling without replacement is an A-star search over regions: the region of all segmentations
has a Gumbel distributed maximum; following the lattice's own probabilities down from it finds
the segmentation that attains it, and what is left at each step is a region whose maximum is a
Gumbel truncated by the one above. Popping the highest region again and again yields the
top k of perturbed log probabilities, which is a sample without replacement. The next highest
is the threshold of the inclusion scores. Only regions that can still be popped are kept.

The sampling vocabulary is a parameter; its file is read by each worker. Random numbers come
from the row key. Probabilities of long texts underflow, so scores are logarithms.

Cases: a null text counts as empty; the empty text has one segmentation without pieces, whose
inclusion is certain. A text with fewer segmentations than asked for returns them all. Letters
without a piece become byte pieces, so decoding restores every text. Very long texts are read
whole. Repeated rows, and rows without a key, share their random numbers. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from textpulse.llm.common import bounded, map_with_id, quoted

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
SMOOTHING = 0.5
SEED = 11
# In units of log probability.
FAR_BELOW = 50.0
# Steps of a path that are looked at first.
FIRST_STEPS = 384
NEAR_STEPS = 64
# Texts that are walked together, and their characters; one longer text goes alone.
TEXTS_TOGETHER = 1_000
LETTERS_TOGETHER = 1_000_000
# New parts whose lattices are made together.
PARTS_TOGETHER = 10_000
# Characters whose lattices are kept for the texts that follow; beyond that they start afresh.
LETTERS_KEPT = 1_200_000
# Characters and texts whose results are held together; one longer text goes alone.
CHARACTERS_AT_ONCE = 1_000_000
ROWS_AT_ONCE = 5_000

SPACE = "▁"
_PARTS = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_LETTER_BITS = 21
_LINE_BREAK, _BLANK = b"\n "
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a model file as a trie in arrays.

    Piece numbers beyond the file's last id are letters spelled in bytes: the size of the file
    plus the letter's code point.
    """

    def __init__(self, path: str = VOCABULARY, smoothing: float = SMOOTHING):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.size = model.get_piece_size()
        self.byte_id = np.zeros(256, np.int32)
        self.byte_value = np.zeros(size, np.uint8)
        self.is_byte = np.zeros(size, bool)
        self.text_of: list[str] = [""] * size
        plain = []
        for n in range(size):
            piece = model.id_to_piece(n)
            if model.is_byte(n):
                byte = int(piece[3:-1], 16)
                self.byte_id[byte] = n
                self.byte_value[n] = byte
                self.is_byte[n] = True
            elif not (model.is_control(n) or model.is_unknown(n) or model.is_unused(n)):
                self.text_of[n] = piece.replace(SPACE, " ")
                plain.append(n)
        self.pieces = np.array(self.text_of, dtype=object)
        spelling = [t.encode() for t in self.text_of]
        for n in np.flatnonzero(self.is_byte).tolist():
            spelling[n] = bytes([self.byte_value[n]])
        self.spelling = pa.array(spelling, pa.large_binary())
        # Ids go by rank in the file, and a piece weighs one over its rank.
        self.weight = np.full(size, -math.log(size + 1.0)) * smoothing
        self.weight[plain] = -np.log(np.array(plain) - plain[0] + 2.0) * smoothing
        self.byte_weight = -math.log(size + 1.0) * smoothing

        node_of = {"": 0}
        arcs = {}
        for n in plain:
            piece = self.text_of[n]
            for end in range(1, len(piece) + 1):
                if piece[:end] not in node_of:
                    node_of[piece[:end]] = len(node_of)
                    arcs[node_of[piece[: end - 1]], ord(piece[end - 1])] = node_of[piece[:end]]
        keys = np.array([(a << _LETTER_BITS) + c for a, c in arcs], np.int64)
        self.inner = np.zeros(len(node_of), bool)
        self.inner[keys >> _LETTER_BITS] = True
        # Arcs in a hash table with open places, at most a quarter full.
        bits = max(4, (4 * len(keys)).bit_length())
        self.arc_shift = np.uint64(64 - bits)
        self.arc_key = np.full(1 << bits, -1, np.int64)
        self.arc_to = np.full(1 << bits, -1, np.int32)
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.arc_key[place[left]] < 0]
            self.arc_key[place[free]] = keys[free]
            left = left[self.arc_key[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & (len(self.arc_key) - 1)
        self.arc_to[place] = list(arcs.values())
        # Most searches start at the root: one look for common letters.
        self.root = np.full(2**16, -1, np.int64)
        for (parent, letter), node in arcs.items():
            if parent == 0 and letter < len(self.root):
                self.root[letter] = node
        self.piece_at = np.full(len(node_of), -1, np.int32)
        for n in plain:
            self.piece_at[node_of[self.text_of[n]]] = n

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _GOLDEN) >> self.arc_shift).astype(np.int64)

    def follow(self, state: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The nodes that the letters lead to, -1 without an arc."""
        keys = (state << _LETTER_BITS) + letters
        place = self._place(keys)
        found = self.arc_key[place]
        other = np.flatnonzero((found != keys) & (found >= 0))
        while len(other):
            place[other] = (place[other] + 1) & (len(self.arc_key) - 1)
            found = self.arc_key[place[other]]
            other = other[(found != keys[other]) & (found >= 0)]
        # An open place leads nowhere.
        return self.arc_to[place]

    def ids(self, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the file, with letters spelled in bytes, for lists of pieces one after another."""
        spelled = np.flatnonzero(pieces >= self.size)
        if not len(spelled):
            return pieces, lengths
        letters = (pieces[spelled] - self.size).astype("<u4")
        count = np.ones(len(pieces), np.int64)
        count[spelled] = _byte_count(letters)
        out = np.repeat(pieces, count)
        mask = np.repeat(pieces >= self.size, count)
        in_bytes = letters.tobytes().decode("utf-32-le").encode()
        out[mask] = self.byte_id[np.frombuffer(in_bytes, np.uint8)]
        upto = np.concatenate([[0], np.cumsum(count)])[np.cumsum(lengths)]
        return out, np.diff(upto, prepend=0)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: spaces for space marks, letters for bytes, no leading space."""
        parts = self.pieces[ids]
        spelled = np.flatnonzero(self.is_byte[ids])
        if not len(spelled):
            return "".join(parts.tolist())[1:]
        runs = np.split(spelled, np.flatnonzero(np.diff(spelled) > 1) + 1)
        for run in runs:
            letters = self.byte_value[ids[run]].tobytes().decode(errors="replace")
            parts[run] = ""
            parts[run[0]] = letters
        return "".join(parts.tolist())[1:]

    def restores(self, ids: list[np.ndarray], texts: list[str]) -> list[bool]:
        """Whether each list of ids is decoded to its text; all bytes are looked up at once."""
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        spelled = self.spelling.take(pa.array(flat))
        begins = np.frombuffer(spelled.buffers()[1], np.int64, len(flat) + 1)
        cuts = begins[np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])].tolist()
        written = spelled.buffers()[2].to_pybytes() if len(flat) else b""
        restored = []
        for n, text in enumerate(texts):
            begin, end = cuts[n], cuts[n + 1]
            given = b" " + text.encode() if text else b""
            same = end - begin == len(given) and written.startswith(given, begin)
            # Other bytes may still be read as the same letters.
            restored.append(same or self.decode(ids[n]) == text)
        return restored


def _byte_count(letters: np.ndarray) -> np.ndarray:
    """Bytes that letters are spelled in."""
    return 1 + (letters >= 0x80) + (letters >= 0x800) + (letters >= 0x10000)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, smoothing: float) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path, smoothing)


def split_text(text: str) -> list[str]:
    """Parts that no piece reaches across; a space goes before the first word."""
    return _PARTS.findall(" " + text) if text else []


def split_texts(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The parts of all texts one after another, and how many each text has."""
    given = [b" " + text.encode() if text else b"" for text in texts]
    sizes = np.fromiter(map(len, given), np.int64, len(given))
    data = b"".join(given)
    letters = np.frombuffer(data, np.uint8)
    blank, broken = letters == _BLANK, letters == _LINE_BREAK
    starts = broken.copy()
    starts[1:] |= broken[:-1] | (blank[1:] & ~blank[:-1])
    begins = np.cumsum(sizes) - sizes
    starts[begins[sizes > 0]] = True
    offsets = np.append(np.flatnonzero(starts), len(data))
    parts = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)
    )
    counts = np.diff(np.searchsorted(offsets[:-1], np.append(begins, len(data))))
    return parts.dictionary_encode(), counts


class Lattices:
    """The lattices of many parts in one set of arrays, to which more parts may be added.

    Every character of every part is a node, numbered through. Edges lie in the order of their
    nodes, the longest of a node first, with running probabilities. ``to`` is -1 where a part
    ends. Arrays have room beyond what is in use.
    """

    def __init__(self, vocab: Vocabulary, texts: Sequence[str] = ()):
        self.vocab = vocab
        self.parts = self.letters = self.edges = self.best_pieces_held = 0
        # Of parts.
        self.base = np.empty(0, np.int64)
        self.best_first = np.empty(0, np.int64)
        self.best_count = np.empty(0, np.int64)
        # Of nodes. Drawing looks these up in no order, so they are kept small for the cache.
        self.first = np.empty(0, np.int32)
        self.count = np.empty(0, np.int32)
        # Of edges.
        self.node = np.empty(0, np.int32)
        self.upto = np.empty(0, np.float32)
        self.to = np.empty(0, np.int32)
        self.log = np.empty(0, np.float64)
        self.piece = np.empty(0, np.int32)
        # Pieces of the likeliest paths.
        self.best = np.empty(0, np.int32)
        if texts:
            self.add(texts)

    def _append(self, used: int, **columns: np.ndarray) -> None:
        """Values that go behind the first ``used`` ones of these arrays."""
        for name, values in columns.items():
            held = getattr(self, name)
            if used + len(values) > len(held):
                grown = np.empty(max(used + len(values), len(held) * 5 // 4), held.dtype)
                grown[:used] = held[:used]
                setattr(self, name, grown)
                held = grown
            held[used : used + len(values)] = values

    def add(self, texts: Sequence[str]) -> None:
        """The lattices of further parts."""
        vocab = self.vocab
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        base = np.cumsum(lengths) - lengths
        letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.repeat(base + lengths, lengths)

        # All positions walk the trie together; each step drops those without an arc.
        starts, stops, pieces = [], [], []
        at = np.arange(len(letters))
        state = np.zeros(len(letters), np.int64)
        depth = 0
        while len(at):
            if depth == 0 and letters.max() < len(vocab.root):
                state = vocab.root[letters]
            else:
                state = vocab.follow(state, letters[at + depth])
            known = np.flatnonzero(state >= 0)
            at, state = at[known], state[known]
            depth += 1
            piece = vocab.piece_at[state]
            whole = np.flatnonzero(piece >= 0)
            starts.append(at[whole])
            stops.append(at[whole] + depth)
            pieces.append(piece[whole])
            inside = np.flatnonzero(vocab.inner[state] & (at + depth < ends[at]))
            at, state = at[inside], state[inside].astype(np.int64)
        covered = np.zeros(len(letters), bool)
        covered[starts[0]] = True
        bare = np.flatnonzero(~covered)
        starts.append(bare)
        stops.append(bare + 1)
        pieces.append(vocab.size + letters[bare])
        # Edges go in the order of nodes, the longest piece first: mostly the likeliest one, so
        # that most draws end at once. Every list is in the order of nodes already.
        count = np.bincount(np.concatenate(starts), minlength=len(letters))
        first_edge = np.cumsum(count) - count
        start = np.repeat(np.arange(len(letters)), count)
        stop, piece = np.empty(len(start), np.int64), np.empty(len(start), np.int32)
        free = first_edge.copy()
        for nodes, ends_at, found in zip(starts[::-1], stops[::-1], pieces[::-1], strict=True):
            place = free[nodes]
            stop[place], piece[place] = ends_at, found
            free[nodes] = place + 1
        weight = vocab.weight[np.minimum(piece, vocab.size - 1)]
        spelled = np.flatnonzero(piece >= vocab.size)
        weight[spelled] = vocab.byte_weight * _byte_count(piece[spelled] - vocab.size)

        # From the ends backwards: nodes at the same distance from their part's end together.
        # Nodes, and edges with them, lie in the order of that distance meanwhile. Node
        # ``len(letters)`` stands for every end.
        target = np.where(stop == ends[start], len(letters), stop)
        distance = ends - np.arange(len(letters))
        if lengths.max() < 2**16:
            distance = distance.astype(np.uint16)  # sorted by radix
        order = np.argsort(distance, kind="stable")
        rank = np.empty(len(letters) + 1, np.int64)
        rank[order] = np.arange(len(letters))
        rank[-1] = len(letters)
        counts = count[order]
        edges = _ranges(first_edge[order], counts)
        weights, targets = weight[edges], rank[target[edges]]
        mass = np.zeros(len(letters) + 1)
        best = np.zeros(len(letters) + 1)
        value = np.empty(len(edges))
        best_value = np.empty(len(edges))
        cuts = [0, *(np.flatnonzero(np.diff(distance[order])) + 1).tolist(), len(letters)]
        firsts = np.concatenate([[0], np.cumsum(counts)])
        edge_cuts = firsts[cuts].tolist()
        for n in range(len(cuts) - 1):
            nodes, own = slice(cuts[n], cuts[n + 1]), slice(edge_cuts[n], edge_cuts[n + 1])
            first = firsts[nodes] - edge_cuts[n]
            to = targets[own]
            values = np.add(weights[own], mass[to], out=value[own])
            top = np.maximum.reduceat(values, first)
            share = np.exp(values - np.repeat(top, counts[nodes]))
            mass[nodes] = top + np.log(np.add.reduceat(share, first))
            values = np.add(weights[own], best[to], out=best_value[own])
            best[nodes] = np.maximum.reduceat(values, first)
        log = np.empty(len(start))
        log[edges] = value - np.repeat(mass[:-1], counts)
        # Of equal paths the one with the longest first piece.
        winners = np.flatnonzero(best_value == np.repeat(best[:-1], counts))[::-1]
        best_edge = np.empty(len(letters), np.int64)
        winners = edges[winners]
        best_edge[start[winners]] = winners
        running = np.cumsum(np.exp(log))
        before = np.concatenate([[0.0], running])[first_edge]
        upto = running - np.repeat(before, count)
        upto[first_edge + count - 1] = 2.0
        target = np.where(target == len(letters), -1, target)
        best_path, best_count = _follow(base, target, lambda who, at, step: best_edge[at])

        self._append(
            self.parts,
            base=base + self.letters,
            best_first=np.cumsum(best_count) - best_count + self.best_pieces_held,
            best_count=best_count,
        )
        self._append(self.letters, first=first_edge + self.edges, count=count)
        self._append(
            self.edges,
            node=start + self.letters,
            upto=upto,
            to=np.where(target < 0, -1, target + self.letters),
            log=log,
            piece=piece,
        )
        self._append(self.best_pieces_held, best=piece[best_path])
        self.parts += len(texts)
        self.letters += len(letters)
        self.edges += len(start)
        self.best_pieces_held += len(best_path)

    def kept(self, parts: np.ndarray) -> Lattices:
        """The lattices of these parts alone, numbered in this order."""
        few = Lattices(self.vocab)
        ends = np.append(self.base[1 : self.parts], self.letters)
        length = ends[parts] - self.base[parts]
        nodes = _ranges(self.base[parts], length)
        count = self.count[nodes].astype(np.int64)
        edges = _ranges(self.first[nodes], count)
        node = np.repeat(np.arange(len(nodes)), count)
        best_count = self.best_count[parts]
        few._append(
            0,
            base=np.cumsum(length) - length,
            best_first=np.cumsum(best_count) - best_count,
            best_count=best_count,
        )
        few._append(0, first=np.cumsum(count) - count, count=count)
        to = self.to[edges]
        few._append(
            0,
            node=node,
            upto=self.upto[edges],
            to=np.where(to < 0, -1, to - self.node[edges] + node),
            log=self.log[edges],
            piece=self.piece[edges],
        )
        few._append(0, best=self.best_pieces(parts))
        few.parts, few.letters, few.edges = len(parts), len(nodes), len(edges)
        few.best_pieces_held = int(best_count.sum())
        return few

    def best_pieces(self, parts: np.ndarray) -> np.ndarray:
        """Pieces of the likeliest segmentation."""
        return self.best[_ranges(self.best_first[parts], self.best_count[parts])]

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths drawn from every node to its part's end; the keys seed the draws."""

        def drawn(who: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
            edge = self.first[at]
            chance = _uniform(keys[who] + np.uint64(step))
            late = np.flatnonzero(self.upto[edge] <= chance)
            while len(late):
                edge[late] += 1
                late = late[self.upto[edge[late]] <= chance[late]]
            return edge

        return _follow(nodes, self.to, drawn)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """So many numbers from each first one on."""
    shift = first - (np.cumsum(count) - count)
    return np.repeat(shift, count) + np.arange(count.sum())


def _follow(
    nodes: np.ndarray, to: np.ndarray, choose: Callable[[np.ndarray, np.ndarray, int], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to its part's end in order, and how many each node has."""
    who = np.flatnonzero(nodes >= 0)
    at = nodes[who]
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    length = np.zeros(len(nodes), np.int64)
    while len(who):
        edge = choose(who, at, len(steps))
        steps.append((who, edge))
        at = to[edge]
        ended = at < 0
        length[who[ended]] = len(steps)
        alive = np.flatnonzero(~ended)
        who, at = who[alive], at[alive]
    offset = np.cumsum(length) - length
    taken = np.empty(int(length.sum()), np.int64)
    for step, (who, edge) in enumerate(steps):
        taken[offset[who] + step] = edge
    return taken, length


def _scrambled(values: np.ndarray) -> np.ndarray:
    values = values * _GOLDEN
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _uniform(keys: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for every key."""
    return (_scrambled(keys) >> np.uint64(11)) * 2.0**-53


@dataclass
class Sample:
    """A segmentation: its edges, log probability, perturbed value and log inclusion."""

    edges: np.ndarray
    log_probability: float
    perturbed: float
    log_inclusion: float = 0.0


def _truncated(location: np.ndarray, bound: np.ndarray, exponential: np.ndarray) -> np.ndarray:
    """Gumbel variables of these locations, each no higher than its bound."""
    return -np.logaddexp(-bound, np.log(exponential) - location)


def _highest(values: np.ndarray, k: int) -> float:
    """The k-th highest value; minus infinity if there are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else -math.inf


def _log_rest(log_share: np.ndarray) -> np.ndarray:
    """log(1 - share); minus infinity where nothing is left."""
    rest = -np.expm1(np.minimum(log_share, 0.0))
    return np.where(rest > 1e-12, np.log(np.maximum(rest, 1e-12)), -np.inf)


@dataclass
class _Path:
    """Edges of a segmentation, their log probabilities and the sums before the first steps."""

    edges: np.ndarray
    logs: np.ndarray
    sums: np.ndarray


@dataclass
class _Search:
    """The search for one text, between the walks of a turn."""

    starts: np.ndarray
    random: np.random.Generator
    nodes: np.ndarray
    bound: float
    paths: list[_Path] = field(default_factory=list)
    samples: list[Sample] = field(default_factory=list)
    # Regions: (-maximum, number, path, step, edges left at that step or None for all but the path's).
    queue: list[tuple[float, int, int, int, np.ndarray | None]] = field(default_factory=list)
    numbers: int = 0
    # The path that is followed up to the edge which the walks continue, if any.
    before: _Path | None = None
    step: int = 0
    taken: int = 0

    def push(self, highest: float, path: int, step: int, left: np.ndarray | None) -> None:
        heapq.heappush(self.queue, (-highest, self.numbers, path, step, left))
        self.numbers += 1

    def join(self, tail: np.ndarray, logs: np.ndarray, log: np.ndarray) -> int:
        """Take a walked tail as the next path; its steps from the one returned on are new."""
        if self.before is None:
            self.paths.append(_Path(tail, logs, tail))
            return 0
        at = slice(0, self.step)
        self.paths.append(
            _Path(
                np.concatenate([self.before.edges[at], [self.taken], tail]),
                np.concatenate([self.before.logs[at], [log[self.taken]], logs]),
                tail,
            )
        )
        return self.step + 1

    def near_steps(self, fresh: int, k: int) -> tuple[int, np.ndarray]:
        """How many new steps can matter, and what is left at the first of them.

        The others among them, and all further ones, are too low for the k highest.
        """
        # A region's maximum is never 40 above its location (noise has 64 bits), so regions
        # that far below k others cannot be among the highest k: the first steps suffice.
        path = self.paths[-1]
        reach, step = fresh, FIRST_STEPS
        while True:
            reach, step = min(reach + step, len(path.edges)), 4 * step
            sums = np.empty(reach + 1)
            sums[0] = 0.0
            np.cumsum(path.logs[:reach], out=sums[1:])
            path.sums = sums
            # Sums go down, and what is left at a step is below the sum before it.
            few = min(fresh + NEAR_STEPS, reach)
            rest = sums[fresh:few] + _log_rest(path.logs[fresh:few])
            if few == reach:
                return reach - fresh, rest
            floor = _highest(rest, k) - FAR_BELOW
            if sums[few] >= floor:
                near = reach - int(np.searchsorted(sums[few:reach][::-1], floor))
                more = sums[few:near] + _log_rest(path.logs[few:near])
                rest = np.concatenate([rest, more])
                floor = _highest(rest, k) - FAR_BELOW
            if reach == len(path.edges) or sums[-1] < floor:
                return reach - fresh, rest

    def descend(self, lattices: Lattices) -> None:
        """Enter the highest region: its next edge, and the nodes to walk from."""
        highest, _, number, step, left = heapq.heappop(self.queue)
        self.bound = -highest
        path = self.paths[number]
        if left is None:
            node = int(lattices.node[path.edges[step]])
            first = int(lattices.first[node])
            left = np.arange(first, first + int(lattices.count[node]))
            left = left[left != path.edges[step]]
        logs = lattices.log[left]
        shares = np.exp(logs - logs.max())
        chance = self.random.random() * shares.sum()
        nth = min(int(np.searchsorted(np.cumsum(shares), chance, side="right")), len(left) - 1)
        self.taken = int(left[nth])
        if len(left) > 1:
            others = left[left != self.taken]
            mass = path.sums[step] + np.logaddexp.reduce(lattices.log[others])
            again = _truncated(mass, self.bound, self.random.standard_exponential())
            self.push(float(again), number, step, others)
        here = int(np.count_nonzero(lattices.to[path.edges[:step]] < 0))
        self.before, self.step = path, step
        self.nodes = np.concatenate([[lattices.to[self.taken]], self.starts[here + 1 :]])

    def finish(self) -> list[Sample]:
        """The samples, with their inclusion by the next highest region."""
        threshold = -self.queue[0][0] if self.queue else -math.inf
        for sample in self.samples:
            gap = sample.log_probability - threshold
            # log(1 - exp(-exp(gap))), which is the gap itself where that is far below zero.
            if gap < -30:
                sample.log_inclusion = gap
            elif gap > 3.6:
                sample.log_inclusion = 0.0
            else:
                sample.log_inclusion = math.log(-math.expm1(-math.exp(gap)))
        return self.samples


def _settle(searches: list[_Search], fresh: list[int], k: int) -> None:
    """Record the last path of every search; its new steps leave regions behind."""
    near = [search.near_steps(at, k) for search, at in zip(searches, fresh, strict=True)]
    cuts = [0, *itertools.accumulate(len(rest) for _, rest in near)]
    rest = np.concatenate([rest for _, rest in near])
    exponential = np.empty(len(rest))
    for n, (search, (steps, _)) in enumerate(zip(searches, near, strict=True)):
        noise = search.random.standard_exponential(steps)
        exponential[cuts[n] : cuts[n + 1]] = noise[: cuts[n + 1] - cuts[n]]
    bounds = np.repeat([search.bound for search in searches], np.diff(cuts))
    # Nothing is lowest where nothing is left.
    lowness = -_truncated(rest, bounds, exponential)
    for n, search in enumerate(searches):
        path = search.paths[-1]
        search.samples.append(Sample(path.edges, float(path.logs.sum()), search.bound))
        own = lowness[cuts[n] : cuts[n + 1]]
        steps = np.arange(len(own)) if len(own) <= k else np.argpartition(own, k - 1)[:k]
        for step, low in zip(steps.tolist(), own[steps].tolist(), strict=True):
            if low < math.inf:
                search.push(-low, len(search.paths) - 1, fresh[n] + step, None)


def top_segmentations(
    lattices: Lattices, texts: list[np.ndarray], k: int, keys: list, seed: int
) -> list[list[Sample]]:
    """The k segmentations of highest perturbed log probability of each text, highest first.

    Texts are given as the numbers of their parts, and random numbers come from their keys
    alone. The searches go in step, so that the walks of many texts are made as one.
    """
    seeds = np.array([row_seed(key, seed) for key in keys], np.uint64)
    searches = []
    for n, parts in enumerate(texts):
        starts = lattices.base[parts]
        random = np.random.Generator(np.random.PCG64(int(seeds[n])))
        searches.append(_Search(starts, random, starts, -math.log(random.standard_exponential())))
    waiting = list(range(len(searches)))
    turn = 0
    while waiting:
        going = [searches[n] for n in waiting]
        sizes = np.array([len(search.nodes) for search in going])
        offsets = np.cumsum(sizes) - sizes
        turns = _scrambled(seeds[waiting] + np.uint64(turn))
        place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
        walk_keys = _scrambled(np.repeat(turns, sizes) + place.astype(np.uint64))
        edges, length = lattices.walk(np.concatenate([s.nodes for s in going]), walk_keys)
        logs = lattices.log[edges]
        cuts = np.concatenate([[0], np.cumsum(length)])[np.append(offsets, sizes.sum())].tolist()
        fresh = [
            search.join(edges[a:b], logs[a:b], lattices.log)
            for search, a, b in zip(going, cuts[:-1], cuts[1:], strict=True)
        ]
        _settle(going, fresh, k)
        waiting = [n for n in waiting if searches[n].queue and len(searches[n].samples) < k]
        for n in waiting:
            searches[n].descend(lattices)
        turn += 1
    return [search.finish() for search in searches]


def row_seed(key: object, seed: int) -> int:
    digest = hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big")


@dataclass
class Encoded:
    """A text's likeliest segmentation and its samples, as ids of the file."""

    ids: np.ndarray
    samples: list[tuple[np.ndarray, Sample]]


class PartStore:
    """Lattices of the parts met so far, which texts that follow share.

    When there are too many letters, the parts that came most often stay, with half of them.
    """

    def __init__(self, vocab: Vocabulary):
        self.names = pa.array([], pa.large_string())
        self.lattices = Lattices(vocab)
        self.met = np.empty(0, np.int64)

    def _shrink(self) -> None:
        often = np.argsort(-self.met, kind="stable")
        often = often[self.met[often] > 1]
        lengths = np.diff(self.lattices.base[: len(self.names)], append=self.lattices.letters)
        stay = np.sort(often[np.cumsum(lengths[often]) <= LETTERS_KEPT // 2])
        self.lattices = self.lattices.kept(stay)
        self.names = self.names.take(pa.array(stay))
        self.met = self.met[stay]

    def take(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the parts of the next texts."""
        if self.lattices.letters > LETTERS_KEPT:
            self._shrink()
        known = len(self.names)
        parts, counts = split_texts(texts)
        found = pc.index_in(parts.dictionary, value_set=self.names)
        fresh = parts.dictionary.filter(found.is_null())
        numbers = found.fill_null(-1).to_numpy().astype(np.int64)
        numbers[numbers < 0] = np.arange(known, known + len(fresh))
        for begin in range(0, len(fresh), PARTS_TOGETHER):
            some = fresh.slice(begin, PARTS_TOGETHER)
            self.lattices.add(some.to_numpy(zero_copy_only=False).tolist())
        self.names = pa.concat_arrays([self.names, fresh])
        places = parts.indices.to_numpy()
        self.met = np.concatenate([self.met, np.zeros(len(fresh), np.int64)])
        self.met[numbers] += np.bincount(places, minlength=len(numbers))
        return np.split(numbers[places], np.cumsum(counts)[:-1])


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in order, as many together as the limits allow."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and (len(group) == TEXTS_TOGETHER or size + len(text) > LETTERS_TOGETHER):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def encode_texts(
    vocab: Vocabulary,
    texts: list[str | None],
    keys: list,
    k: int = SAMPLES,
    seed: int = SEED,
    store: PartStore | None = None,
) -> Iterator[Encoded]:
    """Encode texts in order; a store keeps the work on parts for further calls."""
    store = store or PartStore(vocab)
    begin = 0
    for together in _groups(text or "" for text in texts):
        group = store.take(together)
        lattices = store.lattices
        filled = [n for n, place in enumerate(group) if len(place)]
        drawn: dict[int, list[Sample]] = {}
        if k and filled:
            results = top_segmentations(
                lattices, [group[n] for n in filled], k, [keys[begin + n] for n in filled], seed
            )
            drawn = dict(zip(filled, results, strict=True))
        places = [group[n] for n in filled]
        best = _split_ids(
            vocab,
            lattices.best_pieces(np.concatenate([np.empty(0, np.int64), *places])),
            [int(lattices.best_count[place].sum()) for place in places],
        )
        paths = [s.edges for n in filled for s in drawn.get(n, [])]
        edges = np.concatenate([np.empty(0, np.int64), *paths])
        sampled = iter(_split_ids(vocab, lattices.piece[edges], [len(path) for path in paths]))
        of_text = dict(zip(filled, best, strict=True))
        for n in range(len(group)):
            if n not in of_text:
                nothing = np.empty(0, np.int32)
                whole = [(nothing, Sample(nothing, 0.0, 0.0, 0.0))]
                yield Encoded(nothing, whole if k else [])
                continue
            samples = drawn.get(n, [])
            yield Encoded(of_text[n], [(next(sampled), s) for s in samples])
        begin += len(group)


def _split_ids(vocab: Vocabulary, pieces: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """Ids of the file for lists of pieces, which lie one after another."""
    ids, lengths = vocab.ids(pieces, np.array(lengths, np.int64))
    ends = np.cumsum(lengths).tolist()
    return [ids[begin:end] for begin, end in itertools.pairwise([0, *ends])]


def _offsets(lengths: Iterable[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(lengths, np.int64))]).astype(np.int32)


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    values = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(_offsets(map(len, ids)), pa.array(values))


def _encoded_rows(
    docs: DataFrame,
    text: str,
    doc_id: str,
    columns: str,
    of_piece: Callable[[Vocabulary, list[str], list[Encoded]], dict[str, pa.Array]],
    vocabulary_file: str,
    samples: int,
    smoothing: float,
    seed: int,
) -> DataFrame:
    """The id of each row with columns made of its encoding, a bounded piece of rows at a time."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_file, smoothing)
        store = PartStore(vocab)
        for piece in bounded(batches, CHARACTERS_AT_ONCE, ROWS_AT_ONCE):
            texts = [t or "" for t in piece["text"].to_pylist()]
            keys = piece["doc_id"].to_pylist()
            found = list(encode_texts(vocab, texts, keys, samples, seed, store))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": piece["doc_id"], **of_piece(vocab, texts, found)}
            )

    return map_with_id(rows, encoded, columns, arrow=True)


_ARRAYS = "array<struct<ids:array<int>,log_probability:double,log_inclusion:double>>"


def encode(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    vocabulary_file: str = VOCABULARY,
    samples: int = SAMPLES,
    smoothing: float = SMOOTHING,
    seed: int = SEED,
) -> DataFrame:
    """Piece ids of each text and of its sampled segmentations."""

    def columns(vocab: Vocabulary, texts: list[str], found: list[Encoded]) -> dict[str, pa.Array]:
        drawn = [sample for e in found for sample in e.samples]
        structs = pa.StructArray.from_arrays(
            [
                _id_lists([ids for ids, _ in drawn]),
                pa.array([s.log_probability for _, s in drawn], pa.float64()),
                pa.array([s.log_inclusion for _, s in drawn], pa.float64()),
            ],
            ["ids", "log_probability", "log_inclusion"],
        )
        of_text = _offsets(len(e.samples) for e in found)
        return {
            "ids": _id_lists([e.ids for e in found]),
            "samples": pa.ListArray.from_arrays(of_text, structs),
        }

    return _encoded_rows(
        docs, text, doc_id, f"ids array<int>, samples {_ARRAYS}", columns,
        vocabulary_file, samples, smoothing, seed,
    )


def decode(
    encoded: DataFrame, ids: str = "ids", doc_id: str = "doc_id", vocabulary_file: str = VOCABULARY
) -> DataFrame:
    """Texts of piece ids; null ids give a null text."""
    rows = encoded.select(quoted(doc_id).alias("doc_id"), quoted(ids).alias("ids"))

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(vocabulary_file, SMOOTHING)
        for batch in batches:
            texts = [None if i is None else vocab.decode(np.asarray(i)) for i in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    return map_with_id(rows, decoded, "text string")


def _digest(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<i4"))


def segmentation_report(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    vocabulary_file: str = VOCABULARY,
    samples: int = SAMPLES,
    smoothing: float = SMOOTHING,
    seed: int = SEED,
) -> DataFrame:
    """Piece ids of each text and of its sampled segmentations, and whether decoding restores it.

    ``restored`` is about the likeliest segmentation and ``samples_restored`` about all sampled
    ones. ``samples`` counts the distinct segmentations found and ``sample_*`` describe them,
    the highest perturbed probability first.
    """

    def columns(vocab: Vocabulary, texts: list[str], found: list[Encoded]) -> dict[str, pa.Array]:
        drawn = [sample for e in found for sample in e.samples]
        of_text = _offsets(len(e.samples) for e in found)

        def of_samples(values: Iterable, kind: pa.DataType) -> pa.ListArray:
            return pa.ListArray.from_arrays(of_text, pa.array(values, kind))

        drawn_from = [given for given, e in zip(texts, found, strict=True) for _ in e.samples]
        right = iter(vocab.restores([ids for ids, _ in drawn], drawn_from))
        return {
            "ids": _id_lists([e.ids for e in found]),
            "n_pieces": pa.array([len(e.ids) for e in found], pa.int64()),
            "ids_crc32": pa.array([_digest(e.ids) for e in found], pa.int64()),
            "restored": pa.array(vocab.restores([e.ids for e in found], texts), pa.bool_()),
            "samples": pa.array([len(e.samples) for e in found], pa.int64()),
            "sample_pieces": of_samples([len(ids) for ids, _ in drawn], pa.int64()),
            "sample_crc32": of_samples([_digest(ids) for ids, _ in drawn], pa.int64()),
            "sample_log_probability": of_samples(
                [s.log_probability for _, s in drawn], pa.float64()
            ),
            "sample_log_inclusion": of_samples([s.log_inclusion for _, s in drawn], pa.float64()),
            "sample_ids": pa.ListArray.from_arrays(of_text, _id_lists([ids for ids, _ in drawn])),
            "samples_restored": pa.array(
                [all([next(right) for _ in e.samples]) for e in found], pa.bool_()
            ),
        }

    schema = (
        "ids array<int>, n_pieces long, ids_crc32 long, restored boolean, samples long, "
        "sample_pieces array<long>, sample_crc32 array<long>, "
        "sample_log_probability array<double>, sample_log_inclusion array<double>, "
        "sample_ids array<array<int>>, samples_restored boolean"
    )
    return _encoded_rows(
        docs, text, doc_id, schema, columns, vocabulary_file, samples, smoothing, seed
    )
