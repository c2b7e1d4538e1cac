"""Self-join of documents by the Jaccard similarity of their word shingles.

Every document is a set of hashed shingles; equal sets form a class, and classes are joined.
Any two similar sets share a token among the first quarter of each in a common order, so only
that prefix is indexed. The order puts tokens that many documents have last; it rests on
counts over all documents, kept in a table of fixed size (an order by rough counts is as
exact as any other).

Index lists are skipped by their blocks: a list is sorted by set size, and a block passes over
blocks outside its size range and over those whose least positions leave too few tokens after
the shared one. Entries of short lists that have no partner by these rules are left out before
bitmaps go to the lists. Pairs that a list leaves are held against a bitmap of each set, whose
differing bits are at most the differing tokens, so that only pairs which are similar or nearly
so are candidates.

Relations between sets save most comparisons of candidates, in three rounds. First every set is
compared to one leader of its lists, which ties groups of near copies together. Then every
bucket of lists offers a forest: candidates between groups, the likeliest first, of which none
joins what the others tie together already. That is fewer pairs than index entries, and if all
are links, no candidate of the bucket is left between different groups. What is left is between
groups that a refuted candidate hangs together with; there, last, every candidate between two
groups is compared. Candidates come sorted by group, so that like sets follow each other: a
set's overlaps are derived from those of the set before it by the tokens in which the two differ.

Hot spots: copies are one class from the start; a token of very many documents is spread over
buckets by its count; a list gets one comparison per set, not all pairs; pairs inside a group
that is known to be connected are never formed. Long lists that reach over several groups are
cut into blocks of bounded size, and blocks of one group alone never meet. Links and components stay on the executors.

Shingles and sets are compared by 64-bit hashes, which makes a wrong link possible but not
likely (about 1e-12 for two sets of 3000 shingles).

Cases: a null or blank text has no shingle and is linked with nothing. Very long texts are
read whole. Repeated rows are copies of each other; rows without an id take part and get the
least id of their component. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import (
    WHITE_SPACE,
    bounded,
    drop_written,
    map_with_id,
    quoted,
    result_only,
    written,
)
from textpulse.llm.components import components

WORDS = 5
# Fixed value: the threshold as a fraction, 75 of 100.
NUMERATOR, DENOMINATOR = 3, 4

COUNTERS = 2**20
SLICES = 64
POSTINGS_PER_BUCKET = 1_000_000
HOT_DOCUMENTS = 200_000
BLOCK_ENTRIES = 2_048
BUCKET_BYTES = 2**25
FILTER_BITS = 2**24

CHARS_AT_ONCE = 400_000
# Characters and rows whose results a worker holds together.
CHARACTERS_HELD = 4_000_000
ROWS_HELD = 4_096
PAIRS_AT_ONCE = 500_000
HEAD = 16

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64
)


def _multiplier(place: int) -> np.uint64:
    """One odd number for each word of a shingle."""
    turn = (2 * (place // len(_MULTIPLIERS)) + 1) * 0x9E3779B97F4A7C15
    return np.uint64(int(_MULTIPLIERS[place % len(_MULTIPLIERS)]) * (turn | 1) % 2**64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in WHITE_SPACE]] = True
# A pseudo-random number for each byte value.
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _distinct(sorted_values: np.ndarray) -> np.ndarray:
    keep = np.ones(len(sorted_values), bool)
    keep[1:] = sorted_values[1:] != sorted_values[:-1]
    return sorted_values[keep]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many each text has.

    A word's hash is the sum over its bytes of a number for the byte times an odd number for
    its place.
    """
    encoded = [(text or "").encode() for text in texts]
    codes = _LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)]
    inside = np.flatnonzero(~_SPACE[codes])
    fresh = np.ones(len(inside), bool)
    fresh[1:] = np.diff(inside) > 1
    first = np.flatnonzero(fresh)
    lengths = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    longest = int(lengths.max(initial=1))
    factor = _mixed(np.arange(1, longest + 1, dtype=np.uint64)) | np.uint64(1)
    parts = _BYTES[codes[inside]] * factor[place]
    hashes = np.add.reduceat(parts, first) if len(first) else np.empty(0, np.uint64)
    ends = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.diff(np.searchsorted(inside[first], ends), prepend=0)
    return _mixed(hashes + lengths.astype(np.uint64)), counts


def many_shingles(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; a short text is one shingle."""
    if not texts:
        return []
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    whole = max(len(hashes) - words + 1, 0)
    tokens = np.zeros(whole, np.uint64)
    for place in range(words):
        tokens += hashes[place : place + whole] * _multiplier(place)
    tokens = _mixed(tokens + np.uint64(words))
    result = []
    for begin, count in zip((ends - counts).tolist(), counts.tolist(), strict=True):
        if count >= words:
            result.append(_distinct(np.sort(tokens[begin : begin + count - words + 1])))
        elif count:
            total = np.full(1, count, np.uint64)
            for place in range(count):
                total += hashes[begin + place : begin + place + 1] * _multiplier(place)
            result.append(_mixed(total))
        else:
            result.append(np.empty(0, np.uint64))
    return result


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    return many_shingles([text], words)[0]


def in_pieces(texts: Iterable[str | None], words: int) -> Iterator[np.ndarray]:
    """Shingles of each text, a few hundred thousand characters at once."""
    piece: list[str | None] = []
    size = 0
    for text in texts:
        piece.append(text)
        size += len(text or "")
        if size >= CHARS_AT_ONCE:
            yield from many_shingles(piece, words)
            piece, size = [], 0
    yield from many_shingles(piece, words)


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit per hash value, flipped by every token; at least twice as many bits as tokens."""
    width = max(64, 2 << int(len(tokens) - 1).bit_length()) if len(tokens) else 64
    place = ((tokens >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def differing_bits(bits_a: Sequence[bytes], bits_b: Sequence[bytes]) -> np.ndarray:
    """Bits in which bitmaps differ; a wider one is folded to the width of the other."""
    widths = np.array([(len(a), len(b)) for a, b in zip(bits_a, bits_b, strict=True)])
    differ = np.zeros(len(widths), np.int64)
    if not len(widths):
        return differ
    for width in np.unique(widths, axis=0).tolist():
        rows = np.flatnonzero((widths == width).all(axis=1))
        sides = [
            np.frombuffer(b"".join([bits[n] for n in rows.tolist()]), "<u8").reshape(len(rows), -1)
            for bits in (bits_a, bits_b)
        ]
        narrow = min(width) // 8
        for n in (0, 1):
            while sides[n].shape[1] > narrow:
                half = sides[n].shape[1] // 2
                sides[n] = sides[n][:, :half] ^ sides[n][:, half:]
        differ[rows] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return differ


def nearly_similar(
    bits_a: Sequence[bytes], bits_b: Sequence[bytes], size_a: np.ndarray, size_b: np.ndarray
) -> np.ndarray:
    """False where bitmaps differ in more bits than similar sets can.

    A token that only one of two sets has flips one bit, so differing bits never exceed
    differing tokens.
    """
    room = size_a + size_b - 2 * least_overlap(size_a, size_b)
    return differing_bits(bits_a, bits_b) <= room


def set_class(tokens: np.ndarray) -> int:
    """One number for a set, as a signed long."""
    return int(np.array(xxhash.xxh3_64_intdigest(tokens.tobytes()), np.uint64).astype(np.int64))


def least_overlap(left: np.ndarray | int, right: np.ndarray | int):
    """Shared tokens that two sets of these sizes need."""
    whole = NUMERATOR + DENOMINATOR
    return (NUMERATOR * (left + right) + whole - 1) // whole


def prefix_length(size: int) -> int:
    return size - (NUMERATOR * size + DENOMINATOR - 1) // DENOMINATOR + 1


class Order:
    """Common order of tokens: rare ones first, then by hash."""

    def __init__(self, counts: np.ndarray):
        # Counters hold a few tokens each; what stands out of that tells a frequent one.
        usual = 8.0 + 4.0 * counts.mean()
        self.level = np.ceil(np.log2(np.maximum(counts / usual, 1))).astype(np.uint8)
        # Buckets that a token's sets are spread over.
        self.spread = np.minimum(counts // HOT_DOCUMENTS, 65_535).astype(np.uint16)

    def _place(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens & np.uint64(COUNTERS - 1)).astype(np.int64)

    def buckets(self, tokens: np.ndarray) -> np.ndarray:
        return self.spread[self._place(tokens)]

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        """The part of a sorted set that is indexed, in order."""
        length = prefix_length(len(tokens))
        level = self.level[self._place(tokens)]
        usual = np.flatnonzero(level == 0)
        if len(usual) >= length:
            return tokens[usual[:length]]
        return tokens[np.argsort(level, kind="stable")[:length]]


def _describe(words: int, names: tuple[str, ...]):
    """Id, size, class and bitmap of each document, and at the end the task's token counts."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in bounded(batches, CHARACTERS_HELD, ROWS_HELD):
            sizes, classes, bits = [], [], []
            waiting: list[np.ndarray] = []
            for tokens in in_pieces(batch["text"].to_pylist(), words):
                sizes.append(len(tokens))
                classes.append(set_class(tokens))
                bits.append(bitmap(tokens) if len(tokens) else None)
                waiting.append(tokens)
                if len(waiting) == 256:
                    counts += _counted(waiting)
                    waiting = []
            counts += _counted(waiting)
            yield pa.RecordBatch.from_pydict(
                {**{name: batch[name] for name in names}, "size": sizes, "class": classes, "bits": bits,
                 "slice": [-1] * len(sizes), "counts": [None] * len(sizes)}, _described(names)
            )
        if counts.any():
            parts = counts.astype("<u4").reshape(SLICES, -1)
            used = [n for n in range(SLICES) if parts[n].any()]
            nothing = [None] * len(used)
            yield pa.RecordBatch.from_pydict(
                {**dict.fromkeys(names, nothing), "size": [-1] * len(used), "class": [0] * len(used),
                 "bits": nothing, "slice": used, "counts": [parts[n].tobytes() for n in used]},
                _described(names),
            )

    return described


def _described(names: tuple[str, ...]) -> pa.Schema:
    columns = {"size": pa.int32(), "class": pa.int64(), "bits": pa.binary()}
    counts = {"slice": pa.int32(), "counts": pa.binary()}
    return pa.schema({**dict.fromkeys(names, pa.string()), **columns, **counts})


def _counted(sets: list[np.ndarray]) -> np.ndarray:
    if not sets:
        return np.zeros(COUNTERS, np.int64)
    place = np.concatenate(sets) & np.uint64(COUNTERS - 1)
    return np.bincount(place.astype(np.int64), minlength=COUNTERS)


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(COUNTERS // SLICES, np.int64)
    for counts in group["counts"]:
        total += np.frombuffer(counts, "<u4")
    return pd.DataFrame({"slice": [group["slice"].iloc[0]], "counts": [total.tobytes()]})


def describe(
    docs: DataFrame, text: str, ids: dict[str, str], words: int
) -> tuple[DataFrame, Order]:
    """Ids, size, class and bits of every row, and the order of tokens."""
    names = tuple(ids)
    rows = docs.select(*[quoted(c).alias(n) for n, c in ids.items()], quoted(text).alias("text"))
    columns = "size int, class long, bits binary, slice int, counts binary"
    found = written(map_with_id(rows, _describe(words, names), columns, names, arrow=True), "sets")
    slices = found.filter("slice >= 0").select("slice", "counts")
    # A fixed number of counters, whatever the corpus. Tasks meet slice by slice in two steps.
    parts = slices.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(32)))
    parts = parts.groupBy("slice", "part").applyInPandas(_added, "slice int, counts binary")
    total = np.zeros((SLICES, COUNTERS // SLICES), np.int64)
    for row in parts.groupBy("slice").applyInPandas(_summed, "slice int, counts binary").collect():
        total[row["slice"]] = np.frombuffer(row["counts"], "<i8")
    described = found.filter("slice < 0").select(*names, "size", "class", "bits")
    return described, Order(total.ravel())


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(COUNTERS // SLICES, np.int64)
    for counts in group["counts"]:
        total += np.frombuffer(counts, "<i8")
    return pd.DataFrame({"slice": [group["slice"].iloc[0]], "counts": [total.tobytes()]})


def _post(order: Order, buckets: int, words: int):
    """Prefix tokens of every class that a task meets, packed by bucket."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in bounded(batches, CHARACTERS_HELD, ROWS_HELD):
            tokens, classes, sizes, places = [], [], [], []
            for whole in in_pieces(batch["text"].to_pylist(), words):
                if not len(whole):
                    continue
                name = set_class(whole)
                if name in met:
                    continue
                met.add(name)
                prefix = order.prefix(whole)
                tokens.append(prefix)
                classes.append(np.full(len(prefix), name, np.int64))
                sizes.append(np.full(len(prefix), len(whole), np.int32))
                places.append(np.arange(len(prefix), dtype=np.int32))
            if not tokens:
                continue
            token, name, size, place = map(np.concatenate, (tokens, classes, sizes, places))
            # A token of very many documents goes to several buckets; all its sets are reported.
            spread = np.maximum(order.buckets(token), 1).astype(np.uint64)
            salt = name.astype(np.uint64) % spread
            bucket = (_mixed(token + salt) % np.uint64(buckets)).astype(np.int32)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
            pieces = np.split(by_bucket, cuts)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([int(bucket[p[0]]) for p in pieces], pa.int32()),
                    "token": [token[p].astype("<u8").tobytes() for p in pieces],
                    "class": [name[p].astype("<i8").tobytes() for p in pieces],
                    "size": [size[p].astype("<i4").tobytes() for p in pieces],
                    "place": [place[p].astype("<i4").tobytes() for p in pieces],
                }
            )

    return posted


_BLOCKS = "bucket int, token binary, class binary, size binary, place binary"
_SHARED = "token long, class long, size int, place int"


def _shared(order: Order):
    """Index entries whose token has several classes; the others can have no partner."""

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        token, name, size, place = (
            np.concatenate([np.frombuffer(b, kind) for b in group[column]])
            for column, kind in (("token", "<u8"), ("class", "<i8"), ("size", "<i4"), ("place", "<i4"))
        )
        order_ = np.lexsort((name, token))
        token, name, size, place = token[order_], name[order_], size[order_], place[order_]
        # Copies of a class come from several tasks.
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        token, name, size, place = token[fresh], name[fresh], size[fresh], place[fresh]
        same = token[1:] == token[:-1]
        several = np.zeros(len(token), bool)
        several[1:] |= same
        several[:-1] |= same
        several |= order.buckets(token) > 0
        return pd.DataFrame(
            {
                "token": token[several].astype(np.int64),
                "class": name[several],
                "size": size[several],
                "place": place[several],
            }
        )

    return shared


def possible(size_a, place_a, size_b, place_b):
    """Whether two sets may be similar if the token at these places is their first shared one."""
    room = 1 + np.minimum(size_a - place_a, size_b - place_b) - 1
    return room >= least_overlap(size_a, size_b)


def _leader_pairs(index: DataFrame) -> DataFrame:
    """One comparison per set: with the list leader that it shares most lists with.

    A leader counts only in lists where size and place allow similarity.
    """
    leader = F.min(F.struct("class", "size", "place")).alias("_l")
    leaders = index.groupBy("token").agg(leader)
    leaders = leaders.select(
        "token",
        F.col("_l.class").alias("b"),
        F.col("_l.size").alias("_size"),
        F.col("_l.place").alias("_place"),
    )
    whole = NUMERATOR + DENOMINATOR
    need = F.ceil(NUMERATOR * (F.col("size") + F.col("_size")) / whole)
    room = F.least(F.col("size") - F.col("place"), F.col("_size") - F.col("_place"))
    pairs = index.join(leaders, "token").filter(F.col("class") != F.col("b")).filter(room >= need)
    shared = pairs.groupBy(F.col("class").alias("a"), "b").agg(F.count(F.lit(1)).alias("_lists"))
    best = F.max(F.struct("_lists", "b")).alias("_best")
    return shared.groupBy("a").agg(best).select("a", F.col("_best.b").alias("b"))


def _heads(index: DataFrame) -> DataFrame:
    """The shared tokens at the first places of each set."""
    first = index.filter(F.col("place") < HEAD)
    entry = F.collect_list(F.struct("place", "token"))
    heads = first.groupBy("class").agg(F.array_sort(entry).alias("_head"))
    return heads.select("class", F.col("_head.place").alias("hp"), F.col("_head.token").alias("ht"))


def met_before(
    tokens_a: np.ndarray, places_a: np.ndarray, tokens_b: np.ndarray, place_a: np.ndarray
) -> np.ndarray:
    """Whether two sets share a head token before the place at which they meet.

    Then their pair comes up in that token's list and needs no mention here.
    """
    early = places_a < place_a[:, None]
    return ((tokens_a[:, :, None] == tokens_b[:, None, :]).any(axis=2) & early).any(axis=1)


def list_pairs(
    names: np.ndarray, groups: np.ndarray, sizes: np.ndarray, places: np.ndarray, block: int = 256
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one index list that may be similar and are of different groups.

    The list is sorted by size and cut into blocks. For a block of sets only the blocks whose
    sizes reach far enough are visited, and whose positions leave enough tokens.
    """
    order = np.argsort(sizes, kind="stable")
    names, groups, sizes, places = names[order], groups[order], sizes[order], places[order]
    # A set of size s has partners of size s up to s times 4/3.
    reach = np.searchsorted(sizes, sizes * DENOMINATOR // NUMERATOR, side="right")
    # The most tokens that a set of each block has from the shared one on.
    starts = np.arange(0, len(sizes), block)
    rest = np.maximum.reduceat(sizes - places, starts) if len(sizes) else starts
    for begin in starts.tolist():
        rows = np.arange(begin, min(begin + block, len(sizes)))
        for other in range(begin, int(reach[rows[-1]]), block):
            least = least_overlap(int(sizes[begin]), int(sizes[other]))
            if min(rest[begin // block], rest[other // block]) < least:
                continue
            columns = np.arange(other, min(other + block, int(reach[rows[-1]])))
            if groups[rows[0]] == groups[columns[0]] and (
                (groups[rows] == groups[rows[0]]).all() and (groups[columns] == groups[rows[0]]).all()
            ):
                continue
            a, b = rows[:, None], columns[None, :]
            good = (a < b) & (b < reach[a]) & (groups[a] != groups[b])
            good &= possible(sizes[a], places[a], sizes[b], places[b])
            i, j = np.nonzero(good)
            if len(i):
                yield names[rows[i]], names[columns[j]]


def has_partner(
    tokens: np.ndarray, groups: np.ndarray, sizes: np.ndarray, places: np.ndarray
) -> np.ndarray:
    """Which entries are in a pair of ``list_pairs``, for many lists at once.

    Entries come sorted by token and size; each step holds all of them against the ones so
    many places on.
    """
    found = np.zeros(len(tokens), bool)
    reach = sizes * DENOMINATOR // NUMERATOR
    at, step = np.arange(len(tokens)), 1
    while len(at := at[at + step < len(tokens)]):
        other = at + step
        near = (tokens[at] == tokens[other]) & (sizes[other] <= reach[at])
        at, other = at[near], other[near]
        good = groups[at] != groups[other]
        good &= possible(sizes[at], places[at], sizes[other], places[other])
        found[at[good]] = found[other[good]] = True
        step += 1
    return found


def _partnered(entries: pd.DataFrame) -> pd.DataFrame:
    entries = entries.sort_values(["token", "size"], kind="stable")
    columns = (entries[c].to_numpy() for c in ("token", "component", "size", "place"))
    kept = entries[has_partner(*columns)]
    return kept[["token", "class", "size", "place", "component"]]


LEFT, RIGHT, WITHIN = 0, 1, 2


def list_blocks(entries: DataFrame, most: int) -> DataFrame:
    """Entries of long index lists, once for each pair of blocks that they take part in.

    A list is dealt by set size and, where a component has many entries of a size, by
    component; what is more than ``most`` is dealt on by class. Blocks meet if their sizes
    reach each other and they are not of one component alone. All rows of a pair of blocks
    have one ``_bucket``; ``side`` tells the two blocks apart.
    """
    # Levels are steps of 4/3, but what meets is decided by the sizes themselves.
    step = float(np.log(DENOMINATOR / NUMERATOR))
    entries = entries.withColumn("_level", F.floor(F.log("size") / F.lit(step)).cast("int"))
    parts = entries.groupBy("token", "_level", "component").agg(
        F.count(F.lit(1)).alias("_n"), F.min("size").alias("_low"), F.max("size").alias("_high")
    )
    parts = written(
        parts.withColumn("_alone", F.when(F.col("_n") >= most // 2, F.col("component"))), "parts"
    )
    alone = parts.filter("_alone is not null").select("token", "_level", "component", "_alone")
    entries = entries.join(alone, ["token", "_level", "component"], "left")
    heaps = parts.groupBy("token", "_level", "_alone").agg(
        F.ceil(F.sum("_n") / most).cast("int").alias("_cuts"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
    )
    heaps = heaps.withColumn("_heap", F.struct("_level", "_alone"))
    heaps = written(heaps.select("token", "_heap", "_cuts", "_low", "_high"), "heaps")
    others = heaps.select(
        "token", *[F.col(c).alias(f"_other{c}") for c in ("_heap", "_cuts", "_low", "_high")]
    )
    meeting = heaps.join(others, "token").filter(
        (NUMERATOR * F.col("_low") <= DENOMINATOR * F.col("_other_high"))
        & (NUMERATOR * F.col("_other_low") <= DENOMINATOR * F.col("_high"))
        & ~F.coalesce(F.col("_heap._alone") == F.col("_other_heap._alone"), F.lit(False))
    )
    # Each heap has its partners as a list, from both ends; its entries find them in one join.
    partner = F.struct("_other_heap", "_other_cuts").alias("_partner")
    meeting = meeting.select("token", "_heap", "_cuts", partner)
    entries = entries.withColumn("_heap", F.struct("_level", "_alone"))
    same_heap = [
        F.col("e.token") == F.col("m.token"),
        F.col("e._heap._level") == F.col("m._heap._level"),
        F.col("e._heap._alone").eqNullSafe(F.col("m._heap._alone")),
    ]
    met = entries.alias("e").join(meeting.alias("m"), same_heap)
    met = met.select("e.token", "class", "size", "place", "component", "e._heap", "_cuts", "_partner")
    cut = F.pmod(F.xxhash64("class"), F.col("_cuts")).cast("int")
    met = met.withColumn("_mine", F.struct("_heap._level", "_heap._alone", cut.alias("_cut")))
    met = met.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_partner._other_cuts") - 1)))
    theirs = F.struct("_partner._other_heap._level", "_partner._other_heap._alone", "_cut")
    met = met.withColumn("_theirs", theirs)
    both = F.array_sort(F.array("_mine", "_theirs"))
    side = F.when(F.col("_mine") == F.col("_theirs"), WITHIN)
    side = side.when(both[0] == F.col("_mine"), LEFT).otherwise(RIGHT)
    return met.select(
        "token", "class", "size", "place", "component",
        side.cast("int").alias("side"), F.xxhash64("token", both).alias("_bucket"),
    )


class Forest:
    """Groups that candidates tie together."""

    def __init__(self, groups: np.ndarray):
        names, self.number = np.unique(groups, return_inverse=True)
        self.root = np.arange(len(names))

    def labels(self) -> np.ndarray:
        """One number for each set, equal where sets hang together."""
        while True:
            further = self.root[self.root]
            if (further == self.root).all():
                return self.root[self.number]
            self.root = further

    def tie(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of these pairs, in their order, join what was apart."""
        ties = np.zeros(len(a), bool)
        root = self.root
        pairs = zip(self.number[a].tolist(), self.number[b].tolist(), strict=True)
        for n, (one, other) in enumerate(pairs):
            while root[one] != one:
                root[one] = one = root[root[one]]
            while root[other] != other:
                root[other] = other = root[root[other]]
            if one != other:
                root[max(one, other)] = min(one, other)
                ties[n] = True
        return ties


_CANDIDATES = "a long, b long, group_a long, group_b long"


def _group_pairs(whole: bool):
    """Candidates between groups in a bucket of index lists, once each.

    Without ``whole`` they are a forest: sets that candidates tie together already are not
    compared again.
    """

    def pairs_of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("token", kind="stable")
        name, first, number = np.unique(
            group["class"].to_numpy(), return_index=True, return_inverse=True
        )
        bits = group["bits"].to_numpy()[first]
        set_size = group["size"].to_numpy()[first].astype(np.int64)
        token, label, size, place, side = (
            group[c].to_numpy() for c in ("token", "component", "size", "place", "side")
        )
        set_label = label[first]
        forest = Forest(set_label)
        if whole:
            # Heads as tables; an empty cell stands at no place that could be early.
            head_token = np.zeros((len(name), HEAD), np.int64)
            head_place = np.full((len(name), HEAD), np.iinfo(np.int32).max, np.int64)
            columns = (group[c].to_numpy()[first] for c in ("ht", "hp"))
            for n, (tokens, places) in enumerate(zip(*columns, strict=True)):
                if tokens is not None:
                    head_token[n, : len(tokens)], head_place[n, : len(places)] = tokens, places
        found: list[np.ndarray] = []
        waiting: list[np.ndarray] = []
        count = 0

        def settle() -> None:
            codes = np.unique(np.concatenate(waiting))
            a, b = codes // len(name), codes % len(name)
            room = set_size[a] + set_size[b]
            room = room - 2 * least_overlap(set_size[a], set_size[b])
            differ = differing_bits(bits[a], bits[b])
            good = np.flatnonzero(differ <= room)
            if not whole:
                good = good[np.argsort(differ[good] / (room[good] + 1), kind="stable")]
                good = good[forest.tie(a[good], b[good])]
            found.append(codes[good])

        labels = forest.labels()
        cuts = np.flatnonzero(np.diff(token)) + 1
        for rows in np.split(np.arange(len(token)), cuts):
            of_set = number[rows]
            for i, j in list_pairs(rows, labels[of_set], size[rows], place[rows]):
                # Two blocks are held against each other; what is inside one has its own turn.
                meet = (side[i] != side[j]) | (side[i] == WITHIN)
                i, j = i[meet], j[meet]
                a, b = number[i], number[j]
                if whole:
                    fresh = ~met_before(head_token[a], head_place[a], head_token[b], place[i])
                    a, b = a[fresh], b[fresh]
                waiting.append(np.minimum(a, b) * len(name) + np.maximum(a, b))
                count += len(a)
                if count >= PAIRS_AT_ONCE:
                    settle()
                    waiting, count = [], 0
                    if not whole:
                        labels = forest.labels()
        if waiting:
            settle()
        codes = np.unique(np.concatenate([np.empty(0, np.int64), *found]))
        a, b = codes // len(name), codes % len(name)
        return pd.DataFrame(
            {"a": name[a], "b": name[b], "group_a": set_label[a], "group_b": set_label[b]}
        )

    return pairs_of


@dataclass
class Overlaps:
    """Overlaps of a sequence of sets with others, derived from one set to the next.

    The difference between a set and its predecessor is found once; with every further
    partner the overlap changes by the parts of that difference which the partner has.
    """

    previous: np.ndarray | None = None
    known: dict[int, int] = field(default_factory=dict)
    lost: np.ndarray | None = None
    gained: np.ndarray | None = None
    current: np.ndarray | None = None
    fresh: dict[int, int] = field(default_factory=dict)
    derived: int = 0

    def advance(self, tokens: np.ndarray) -> None:
        """Go on to the next set."""
        self.previous, self.known = self.current, self.fresh
        self.current, self.fresh = tokens, {}
        self.lost = self.gained = None

    def with_partner(self, name: int, partner: np.ndarray) -> int:
        before = self.known.get(name)
        if before is not None and self.lost is None:
            shared = _where(self.previous, self.current)
            self.lost = self.previous[~shared]
            self.gained = self.current[~_where(self.current, self.previous)]
        if before is not None and len(self.lost) + len(self.gained) < len(self.current) // 2:
            count = before - int(_where(self.lost, partner).sum())
            count += int(_where(self.gained, partner).sum())
            self.derived += 1
        else:
            count = int(_where(self.current, partner).sum())
        self.fresh[name] = count
        return count


def _where(tokens: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which tokens are among the others; both sorted."""
    if not len(tokens) or not len(others):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(others, tokens), len(others) - 1)
    return others[at] == tokens


def _sets_in(column: pa.BinaryArray) -> list[np.ndarray]:
    """The sets of a batch, as views of its memory."""
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    ends = ends[column.offset :][: len(column) + 1]
    held = memoryview(column.buffers()[2] or b"")
    return [
        np.frombuffer(held[begin:end], "<u8") for begin, end in itertools.pairwise(ends.tolist())
    ]


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among pairs with their sets; rows come sorted so that like sets follow each other."""
    overlaps, last = Overlaps(), None
    for batch in batches:
        keep = np.zeros(len(batch), bool)
        columns = (batch["a"].to_pylist(), batch["b"].to_pylist())
        sets = (_sets_in(batch[c]) for c in ("set_a", "set_b"))
        for n, (a, b, left, right) in enumerate(zip(*columns, *sets, strict=True)):
            if a != last:
                # Kept beyond the batch, whose memory is not.
                overlaps.advance(left.copy())
                last = a
            shared = overlaps.with_partner(b, right)
            keep[n] = shared >= least_overlap(len(overlaps.current), len(right))
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets are similar. A set's pairs lie with those of its group."""
    left = sets.select(F.col("class").alias("a"), F.col("items").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("items").alias("set_b"))
    rows = pairs.join(left, "a").join(right, "b")
    rows = rows.sortWithinPartitions("group_a", "a", "b").select("a", "b", "set_a", "set_b")
    return rows.mapInArrow(_similar, "a long, b long")


def _passing(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs whose bitmaps allow similarity."""

    def passing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = (batch[c].to_numpy(np.int64) for c in ("size_a", "size_b"))
            keep = nearly_similar(list(batch["bits_a"]), list(batch["bits_b"]), *sizes)
            yield batch.loc[keep, ["a", "b"]]

    for side in ("a", "b"):
        renamed = {"class": side, "size": f"size_{side}", "bits": f"bits_{side}"}
        pairs = pairs.join(marks.withColumnsRenamed(renamed), side)
    return pairs.mapInPandas(passing, "a long, b long")


def _chosen_sets(bits: np.ndarray, words: int):
    """Sets whose class may be wanted; the filter has a fixed size."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in bounded(batches, CHARACTERS_HELD, ROWS_HELD):
            names, items = [], []
            for tokens in in_pieces(batch["text"].to_pylist(), words):
                name = set_class(tokens)
                bit = name % FILTER_BITS
                if name in met or not (int(bits[bit >> 6]) >> (bit & 63)) & 1:
                    continue
                met.add(name)
                names.append(name)
                items.append(tokens.astype("<u8").tobytes())
            if names:
                columns = [pa.array(names, pa.int64()), pa.array(items, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["class", "items"])

    return chosen


def _wanted_bits(classes: DataFrame) -> np.ndarray:
    """A bit for every class, FILTER_BITS in all."""
    bits = classes.select(F.pmod(F.col("class"), F.lit(FILTER_BITS)).alias("bit"))
    words = bits.selectExpr("bit div 64 as word", "shiftleft(1L, int(bit % 64)) as mask")
    words = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in words:
        bits[row["word"]] = np.int64(row["mask"]).astype(np.uint64)
    return bits


def _sets_of(wanted: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Sets of these classes."""
    wanted = wanted.select("class").distinct()
    chosen = texts.mapInArrow(_chosen_sets(_wanted_bits(wanted), words), "class long, items binary")
    # The filter lets some others pass.
    chosen = chosen.join(wanted, "class", "left_semi")
    return written(chosen.dropDuplicates(["class"]), "chosen")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class"))


def _across(index: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries of the lists that reach over several groups, with group and length of list."""
    labelled = index.join(groups.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class"))
    across = labelled.groupBy("token").agg(
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
        F.count(F.lit(1)).alias("_entries"),
    )
    across = across.filter("_low != _high").select("token", "_entries")
    return written(labelled.join(across, "token"), "labelled")


@result_only
def _candidates(labelled: DataFrame, marks: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Candidates of all lists: a forest for each bucket, or with heads all of them."""
    short = labelled.filter(F.col("_entries") <= BLOCK_ENTRIES)
    # Most entries have no partner by sizes, places and groups; only the others meet bitmaps.
    least = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(short.count() // POSTINGS_PER_BUCKET + 1, least)
    short = short.withColumn("_bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    short = short.groupBy("_bucket").applyInPandas(_partnered, f"{_SHARED}, component long")
    short = written(short, "partnered")
    # Short lists share buckets, which grow in number with the bitmaps and heads in them.
    weight = short.agg(F.sum(F.col("size") / 2 + 16 * HEAD)).first()[0] or 0
    buckets = max(int(weight // BUCKET_BYTES) + 1, least)
    short = short.select(
        "token", "class", "size", "place", "component", F.lit(WITHIN).alias("side"),
        F.pmod(F.xxhash64("token"), F.lit(buckets)).alias("_bucket"),
    )
    longer = list_blocks(labelled.filter(F.col("_entries") > BLOCK_ENTRIES), BLOCK_ENTRIES)
    entries = short.unionByName(longer).join(marks.drop("size"), "class")
    if heads is not None:
        entries = entries.join(heads, "class", "left")
    found = entries.groupBy("_bucket").applyInPandas(_group_pairs(heads is not None), _CANDIDATES)
    return written(found.distinct(), "pairs")


@result_only
def _still_open(labelled: DataFrame, pairs: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries of the groups that a refuted candidate hangs together with.

    Candidates tie groups together; ``groups`` are those after the links are in. Where all
    candidates of what hangs together were links, or their ends are connected otherwise,
    nothing is left to compare.
    """
    refuted = pairs.join(links, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        now = groups.select(F.col("node").alias(side), F.col("component").alias(f"now_{side}"))
        refuted = refuted.join(now, side, "left")
    apart = F.coalesce("now_a", "a") != F.coalesce("now_b", "b")
    refuted = refuted.filter(apart).select(F.col("group_a").alias("node"))
    ties = components(pairs.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
    left = ties.join(refuted, "node", "left_semi").select("component").distinct()
    left = ties.join(left, "component", "left_semi").select(F.col("node").alias("component"))
    entries = labelled.join(left, "component", "left_semi")
    return written(entries.select("token", "class", "size", "place"), "open")


@result_only
def _linked(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Links among the pairs, written."""
    return written(_links(pairs, _sets_of(_ends(pairs), texts, words)), "links")


@result_only
def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after further links."""
    known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(links))


@result_only
def _led(index: DataFrame, marks: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Groups by the relations of sets to leaders."""
    pairs = written(_passing(_leader_pairs(index), marks), "pairs")
    return components(_linked(pairs.withColumn("group_a", F.col("b")), texts, words))


@result_only
def _grouped(docs: DataFrame, text: str, ids: dict[str, str], words: int) -> DataFrame:
    """Ids of every row, given as new and old names, with the size and component of its set.

    Tables written on the way go as soon as nothing reads them.
    """
    spark = docs.sparkSession
    described, order = describe(docs, text, ids, words)
    texts = docs.select(quoted(text).alias("text"))
    marks = described.filter("size > 0").groupBy("class")
    marks = marks.agg(F.first("size").alias("size"), F.first("bits").alias("bits"))

    # A quarter of the tokens is indexed; buckets grow in number, not in size.
    total = described.agg(F.sum(F.col("size") / DENOMINATOR + 1)).first()[0] or 0
    buckets = int(total // POSTINGS_PER_BUCKET) + 1
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = texts.mapInArrow(_post(order, buckets, words), _BLOCKS)
    index = blocks.groupBy("bucket").applyInPandas(_shared(order), _SHARED)
    index = written(index, "index")
    groups = _led(index, marks, texts, words)

    # Forests of what the lists hold between groups.
    labelled = _across(index, groups)
    drop_written(index)
    pairs = _candidates(labelled, marks, None)
    links = _linked(pairs, texts, words)
    merged = _merged(groups, links)

    # Every candidate where a forest has shown that groups may stay apart.
    rest = _still_open(labelled, pairs, links, merged)
    drop_written(labelled, pairs, links)
    if not rest.isEmpty():
        pairs = _candidates(_across(rest, merged), marks, written(_heads(rest), "heads"))
        merged = _merged(merged, _linked(pairs, texts, words))

    joined = described.join(merged.withColumnRenamed("node", "class"), "class", "left")
    joined = joined.withColumn("_group", F.coalesce("component", "class"))
    return written(joined.select(*ids, "size", "_group"), "joined")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS
) -> DataFrame:
    """Every row with the size of its set and the least id of its component."""
    joined = _grouped(docs, text, {"doc_id": doc_id}, words)
    least = joined.filter("size > 0").groupBy("_group").agg(F.min("doc_id").alias("_least"))
    result = joined.join(least, "_group", "left")
    alone = F.col("size") == 0
    return result.select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS
) -> DataFrame:
    """One row of each component, with all its columns: the one of the least id.

    Rows are told apart by a written number, as ids may be missing or repeated: a row without
    an id stays only if none of its component has one, and of equal ids the first row stays.
    Rows without shingles all stay.
    """
    names = {name.lower() for name in docs.columns}
    number = "_number"
    while number in names:
        number += "_"
    docs = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = _grouped(docs, text, {"doc_id": doc_id, "row": number}, words)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    least = found.filter("size > 0").groupBy("_group").agg(F.min(rank).alias("_least"))
    kept = least.select(F.col("_least.row").alias("_kept"))
    kept = kept.unionByName(found.filter("size = 0").select(F.col("row").alias("_kept")))
    kept = docs.join(kept, F.col(number) == F.col("_kept"), "left_semi")
    return kept.drop(number)
