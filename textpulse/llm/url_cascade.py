"""Judge urls by lists, with a cascade of Bloom filters instead of joins.

A list of keys, each a host with the beginning of a path, is encoded as a cascade. The first
filter holds the listed keys. The corpus's keys that pass it although they are not listed go
into a second filter, the listed keys that pass that one into a third, and so on, until nothing
passes that should not. The number of filters that a key passes in a row then tells exactly, for
every key of the corpus, whether it is listed: it is, if that number is odd. Filters are small
and go out to all tasks, so that rows are judged where they are; nothing is joined or moved.

The keys that a url may match are given by the shapes of the list: so many labels at the end of
the host and so many code points at the beginning of the path. The corpus's complete key universe
are the keys of these shapes of all its urls.

Size: the first filter lets about as many keys of the corpus pass as are listed, so a cascade
takes ``1.44 log2(corpus keys / listed keys)`` bits a listed key and a few more for each further
filter, which is known before it is built. A list whose cascade would be larger than
``MOST_BYTES`` is cut by hash into slices with a cascade each, which go out one after the other.

Cases: a null url, or one without ``://``, has an empty host and path and fits no rule. Of the
rules that fit, the longest one wins, by code points of host and path, then the one with the
longer host; a rule that is listed both to allow and to block blocks. An url without a rule is
blocked if its host or a domain above it is listed and allowed otherwise. Repeated rows each get a
result; a null page_id is carried along. Very long urls are read whole and cost a key a shape. An
empty table, or an empty list, is no special case. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.llm.common import written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"://([^/?#]*)([^?#]*)"

# Bytes of a cascade that may go out to all tasks at once.
MOST_BYTES = 32 * 2**20
# The first filter never lets more than half of the other keys pass, nor fewer than this.
LEAST_PASSING = 2.0**-24
# Bits a key of a filter that lets half of the others pass.
_HALF = 1 / math.log(2)
# A cascade halves what is left with every second filter; so many mean that keys share a hash.
MOST_LEVELS = 200


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
# Domains known for spam; where no rule applies, they are blocked.
LISTED_DOMAINS = tuple(
    f"{name}.example.{top}"
    for name in ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, _URL, 1)
    return F.translate(host, _UPPER, _UPPER.lower()), F.regexp_extract(text, _URL, 2)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass(frozen=True)
class BloomFilter:
    """Bits of the keys of one level; other levels look at other bits of a key."""

    level: int
    size: int
    probes: int
    words: np.ndarray | None = None

    @classmethod
    def planned(cls, level: int, keys: int, passing: float) -> BloomFilter:
        probes = max(1, round(-math.log2(passing)))
        return cls(level, max(64, math.ceil(keys * probes * _HALF)), probes)

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Bit numbers, keys by probes, from two hashes a key."""
        turn = np.uint64((self.level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        start = _mixed(first.astype(np.int64).view(np.uint64) + turn)
        step = _mixed(second.astype(np.int64).view(np.uint64) ^ turn) | np.uint64(1)
        probe = np.arange(self.probes, dtype=np.uint64)
        return _mixed(start[:, None] + probe * step[:, None]) % np.uint64(self.size)

    def passed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        places = self.places(first, second)
        bits = self.words[(places >> np.uint64(6)).astype(np.int64)]
        return ((bits >> (places & np.uint64(63))) & np.uint64(1)).all(axis=1)


@dataclass(frozen=True)
class Cascade:
    """Filters in turn for listed keys and for the others that pass; one slice of all keys."""

    slice: int
    slices: int
    filters: tuple[BloomFilter, ...] = ()

    def depth(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many filters keys pass in a row; none if they are of another slice."""
        depth = np.zeros(len(first), np.int64)
        alive = np.flatnonzero(np.mod(first, self.slices) == self.slice)
        for level, each in enumerate(self.filters, 1):
            alive = alive[each.passed(first[alive], second[alive])]
            depth[alive] = level
        return depth

    def listed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.depth(first, second) % 2 == 1

    @property
    def bytes(self) -> int:
        return sum(each.words.nbytes for each in self.filters)


def _hashes(key: Column) -> tuple[Column, Column]:
    """Two hashes of a key that do not depend on each other."""
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)


def _hashed(keys: DataFrame) -> DataFrame:
    first, second = _hashes(F.col("key"))
    return keys.select("key", first.alias("h1"), second.alias("h2"))


def _bit_maker(plan: BloomFilter) -> Callable:
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = plan.places(batch["h1"].to_numpy(), batch["h2"].to_numpy()).ravel()
            places = np.unique(places)
            word = places >> np.uint64(6)
            bit = np.uint64(1) << (places & np.uint64(63))
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])[: len(word)])
            if len(start):
                yield pd.DataFrame(
                    {
                        "word": word[start].astype(np.int64),
                        "bits": np.bitwise_or.reduceat(bit, start).view(np.int64),
                    }
                )

    return make


def _filled(plan: BloomFilter, keys: DataFrame) -> BloomFilter:
    """The filter of some keys; its words are made by the tasks and put together here."""
    made = keys.select("h1", "h2").mapInPandas(_bit_maker(plan), "word long, bits long")
    # Bounded by the size of the filter.
    found = made.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(plan.size // 64 + 1, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return BloomFilter(plan.level, plan.size, plan.probes, words)


def _passing(keys: DataFrame, level: BloomFilter) -> DataFrame:
    """The keys that pass a filter."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[shared.value.passed(batch["h1"].to_numpy(), batch["h2"].to_numpy())]

    return keys.mapInPandas(choose, keys.schema)


def cascade_slices(
    listed: DataFrame, universe: DataFrame, most_bytes: int = MOST_BYTES
) -> Iterator[Cascade]:
    """The cascades of a list over a universe of keys, slice by slice; ``key`` in both tables.

    The universe may hold keys many times, the listed ones among them.
    """
    listed = written(_hashed(listed.filter("key is not null").distinct()), "listed-keys")
    universe = _hashed(universe.filter("key is not null"))
    known = listed.count()
    if not known:
        yield Cascade(0, 1)
        return
    others = max(1, universe.agg(F.approx_count_distinct("h1")).first()[0])
    passing = min(0.5, max(LEAST_PASSING, known / others))
    # As many others as listed keys pass, and from then on about half of both each time.
    bits = known * (max(1, round(-math.log2(passing))) + 4) * _HALF
    slices = max(1, math.ceil(bits / 8 / most_bytes))
    for number in range(slices):
        in_slice = F.pmod("h1", F.lit(slices)) == number
        yield _cascade(
            listed.filter(in_slice), universe.filter(in_slice), passing, number, slices
        )


def _cascade(
    listed: DataFrame, universe: DataFrame, passing: float, number: int, slices: int
) -> Cascade:
    count = listed.count()
    if not count:
        return Cascade(number, slices)
    filters = [_filled(BloomFilter.planned(0, count, passing), listed)]
    # Keys are brought together only after the filter has taken most of them away.
    wrong = _passing(universe, filters[0]).distinct()
    wrong = written(wrong.join(listed.select("key"), "key", "left_anti"), "passing-keys")
    inside, outside = listed, wrong
    while True:
        count = outside.count()
        if not count:
            return Cascade(number, slices, tuple(filters))
        if len(filters) == MOST_LEVELS:
            raise ValueError("two keys have the same hashes")
        # The next filter holds what passed wrongly; what it should stop is the other side.
        inside, outside = outside, inside
        filters.append(_filled(BloomFilter.planned(len(filters), count, 0.5), inside))
        outside = written(_passing(outside, filters[-1]), "passing-keys")


def _flags(cascade: Cascade, spark: SparkSession) -> Callable:
    shared = spark.sparkContext.broadcast(cascade)

    @F.pandas_udf("array<boolean>")
    def flags(first: pd.Series, second: pd.Series) -> pd.Series:
        sizes = [len(x) for x in first]
        if not sum(sizes):
            return pd.Series([[] for _ in sizes])
        found = shared.value.listed(np.concatenate(list(first)), np.concatenate(list(second)))
        return pd.Series([part.tolist() for part in np.split(found, np.cumsum(sizes)[:-1])])

    return flags


def flag_keys(rows: DataFrame, keys: str, flag: str, cascades: Iterator[Cascade]) -> DataFrame:
    """Rows with an array of booleans that tells which of their keys are listed.

    The rows are written between slices, so that tasks hold one slice at a time.
    """
    spark = rows.sparkSession
    names = rows.columns
    done = None
    for cascade in cascades:
        if done is not None:
            rows = written(done, "flagged")
        first = F.transform(keys, lambda key: _hashes(key)[0])
        second = F.transform(keys, lambda key: _hashes(key)[1])
        found = _flags(cascade, spark)(first, second)
        if done is not None:
            found = F.zip_with(F.col(flag), found, lambda a, b: a | b)
        done = rows.select(*names, found.alias(flag))
    return done


def _keys(shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys of a url that have these shapes: labels of the host, code points of the path."""
    keys = [
        F.concat(F.substring_index("host", ".", -labels), F.expr(f"left(path, {chars})"))
        for labels, chars in shapes
    ]
    return F.array(*keys) if keys else F.array().cast("array<string>")


def _shapes(hosts_and_paths: DataFrame) -> list[tuple[int, int]]:
    """The shapes that a list has; far fewer than keys, as hosts and paths are short."""
    shape = [F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")]
    return sorted((r.labels, r.chars) for r in hosts_and_paths.select(*shape).distinct().collect())


def judge_urls(
    pages: DataFrame, rules: DataFrame, domains: DataFrame, *, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    ``rules`` has host, path and verdict (allow or block), ``domains`` the hosts that are
    blocked where no rule applies.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = rules.select("host", "path", "verdict")
    lists = {
        "allow": rules.filter("verdict = 'allow'").select("host", "path"),
        "block": rules.filter("verdict = 'block'").select("host", "path"),
        "listed": domains.select("host", F.lit("").alias("path")),
    }
    # One cascade for all lists: a key begins with the name of its list.
    keys, known = [], []
    for name, listed in lists.items():
        its_keys = F.array_distinct(_keys(_shapes(listed)))
        keys.append(F.transform(its_keys, _in_list(name)))
        known.append(listed.select(_in_list(name)(F.concat("host", "path")).alias("key")))
    rows = rows.withColumn("_keys", F.concat(*keys))
    universe = rows.select(F.explode("_keys").alias("key"))
    listed = known[0].unionByName(known[1]).unionByName(known[2])
    judged = flag_keys(rows, "_keys", "_hits", cascade_slices(listed, universe, most_bytes))
    return judged.select("page_id", "host", "path", *_verdict())


def _in_list(name: str) -> Callable[[Column], Column]:
    return lambda key: F.concat(F.lit(f"{name} "), key)


def _verdict() -> list[Column]:
    pairs = F.arrays_zip(F.col("_keys").alias("key"), F.col("_hits").alias("hit"))
    hits = F.transform(F.filter(pairs, lambda p: p["hit"]), lambda p: _hit(p["key"]))
    rules = F.filter(hits, lambda hit: hit["list"] != "listed")
    best = F.array_max(rules)
    blocked = F.coalesce(best["list"] == "block", F.size(hits) > 0)
    return [
        best["rule"].alias("rule"),
        F.when(blocked, "block").otherwise("allow").alias("verdict"),
    ]


def _hit(key: Column) -> Column:
    """A key that fits, ordered by length, host's length and list: block is after allow."""
    name = F.substring_index(key, " ", 1)
    rule = F.call_function("substring", key, F.length(name) + 2)
    return F.struct(
        F.length(rule).alias("length"),
        F.length(F.substring_index(rule, "/", 1)).alias("host_length"),
        name.alias("list"),
        rule.alias("rule"),
    )


def judge_pages(pages: DataFrame) -> DataFrame:
    """``judge_urls`` by the rules and domains above."""
    spark = pages.sparkSession
    rules = [(rule.host, rule.path, rule.verdict) for rule in RULES]
    return judge_urls(
        pages,
        spark.createDataFrame(rules, "host string, path string, verdict string"),
        spark.createDataFrame([(host,) for host in LISTED_DOMAINS], "host string"),
    )
