"""Quality rules with an isolation forest on rule statistics.

Every document is reduced to rule statistics in one pass. A forest of random splits measures
how few of them set a document apart from the labelled good rows; documents with shorter mean
paths than a threshold are anomalies. The splits are drawn from the box around all labelled
rows, so that where only bad ones lie, a part is empty after few splits. (Splits inside the good
rows' own range cannot see a statistic that is always zero there.) The threshold keeps all but a
small share of the good rows.

Box, trees and threshold come from all labelled rows, counted in Spark: the splits do not depend
on the rows, so each task counts its rows in the leaves, and a part counts as empty once no more
than one row in ``SAMPLE`` lies in it, as a tree over that many rows would have it on average. The
threshold is an exact rank, found by counting scores in bins. What reaches the driver has a fixed
size.

Cases: a null text has no words and fails the base rules, as an empty one does. Repeated rows
each get a result. Without labelled rows of both kinds there is no forest and the base rules
decide alone. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import map_with_id, quoted, written
from textpulse.llm.training import all_labelled_rows

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

TREES = 100
SAMPLE = 256
DEPTH = 10
GOOD_LOST = 0.001
BINS = 4096

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_same_next")
FEATURES = ("symbols", "dup_lines", "repeats", "upper", "digits", "marks", "word_length", "stutter")

_STATS_SCHEMA = ", ".join(f"{name} long" for name in (*STATS, *MORE))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice, first ones included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[twice + shift] = True
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The rule statistics of one text, in the order of STATS and MORE."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = text.split("\n")
    seen: set[str] = set()
    dup_lines = 0
    for line in lines:
        if line in seen:
            dup_lines += bool(line.encode().split())
        seen.add(line)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    same_next = sum(map(bytes.__eq__, words, words[1:]))
    codes = np.frombuffer(raw, np.uint8)
    upper = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    lower = int(np.count_nonzero((codes >= 97) & (codes <= 122)))
    digits = int(np.count_nonzero((codes >= 48) & (codes <= 57)))
    return (
        len(words),
        len(text) - blanks,
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeated_words(words),
        len(text),
        len(lines),
        upper,
        upper + lower,
        digits,
        text.count("!") + text.count("?"),
        same_next,
    )


def _stats_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [text_stats(text) for text in batch["text"]]
        frame = pd.DataFrame(rows, columns=[*STATS, *MORE], dtype="int64")
        frame.insert(0, "doc_id", batch["doc_id"].array)
        yield frame


def rule_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return map_with_id(rows, _stats_of, _STATS_SCHEMA)


def _saturating(share: np.ndarray, half: float) -> np.ndarray:
    return share / (share + half)


def features(stats: pd.DataFrame) -> np.ndarray:
    """Shares that do not depend on the length of a document, each about 0 to 1."""
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    letters = np.maximum(stats["n_letters"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    columns = [
        _saturating(stats["n_symbols"] / words, 0.1),
        stats["n_dup_lines"] / np.maximum(stats["n_lines"], 1),
        stats["n_repeat_words"] / words,
        stats["n_upper"] / letters,
        _saturating(stats["n_digits"] / chars, 0.1),
        _saturating(stats["n_marks"] / words, 0.1),
        np.log(chars / words) / 4,
        stats["n_same_next"] / words,
    ]
    return np.column_stack([np.asarray(c, float) for c in columns])


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n points; linear in between."""
    whole = np.arange(1, int(np.ceil(np.max(n, initial=2))) + 1)
    harmonic = np.concatenate([[0.0], np.cumsum(1 / whole[:-1])])
    return np.interp(n, whole, 2 * harmonic - 2 * (whole - 1) / whole)


@dataclass(frozen=True)
class Forest:
    """Trees as complete binary arrays: node i has the children 2i + 1 and 2i + 2.

    ``feature`` is -1 in leaves, whose ``value`` is the path length on arrival.
    """

    feature: np.ndarray
    value: np.ndarray
    scale: float

    @property
    def depth(self) -> int:
        return int(np.log2(self.feature.shape[1] + 1)) - 1

    def score(self, points: np.ndarray) -> np.ndarray:
        """Anomaly between 0 and 1; near 1 where few splits set a point apart."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for feature, value in zip(self.feature, self.value, strict=True):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                split = feature[node]
                inner = split >= 0
                right = points[rows, np.maximum(split, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += value[node]
        return 2.0 ** (-total / len(self.feature) / self.scale)


@dataclass(frozen=True)
class Splits:
    """Random splits of a box: complete trees of inner nodes, numbered as in a forest."""

    feature: np.ndarray
    value: np.ndarray
    depth: int

    def leaf_counts(self, points: np.ndarray) -> np.ndarray:
        """How many points lie in each leaf of each tree."""
        leaves = 2**self.depth
        counts = np.zeros((len(self.feature), leaves), np.int64)
        rows = np.arange(len(points))
        for n, (feature, value) in enumerate(zip(self.feature, self.value, strict=True)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (points[rows, feature[node]] >= value[node])
            counts[n] = np.bincount(node - (leaves - 1), minlength=leaves)
        return counts


def draw_splits(
    low: np.ndarray, high: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7
) -> Splits:
    """Splits drawn from the box ``low`` to ``high``, each inside the part that it cuts."""
    random = np.random.default_rng(seed)
    wide = np.flatnonzero(high > low)
    if not len(wide):
        return Splits(np.zeros((trees, 0), np.int64), np.zeros((trees, 0)), 0)
    features, values = [], []
    lower, upper = (np.tile(np.asarray(x, float), (trees, 1, 1)) for x in (low, high))
    for _ in range(depth):
        split = random.choice(wide, lower.shape[:2])[:, :, None]
        at = random.uniform(
            np.take_along_axis(lower, split, 2), np.take_along_axis(upper, split, 2)
        )
        features.append(split[:, :, 0])
        values.append(at[:, :, 0])
        below, above = upper.copy(), lower.copy()
        np.put_along_axis(below, split, at, 2)
        np.put_along_axis(above, split, at, 2)
        # The children of a node lie next to each other.
        lower = np.stack([lower, above], 2).reshape(trees, -1, lower.shape[2])
        upper = np.stack([below, upper], 2).reshape(trees, -1, upper.shape[2])
    return Splits(np.concatenate(features, 1), np.concatenate(values, 1), depth)


def forest_of(splits: Splits, leaf_counts: np.ndarray, sample: int = SAMPLE) -> Forest:
    """The trees that end where a sample of that size has one point on average, or less."""
    total = int(leaf_counts[0].sum())
    sample = min(sample, total)
    levels = [leaf_counts]
    for _ in range(splits.depth):
        levels.append(levels[-1][:, ::2] + levels[-1][:, 1::2])
    counts = np.concatenate(levels[::-1], axis=1)
    size = counts * (sample / total)
    inner = np.arange(counts.shape[1]) < splits.feature.shape[1]
    inner = inner & (size > 1)
    level = np.repeat(np.arange(splits.depth + 1), 2 ** np.arange(splits.depth + 1))
    feature = np.full(counts.shape, -1, np.int64)
    value = level + _expected_path(size)
    at = np.nonzero(inner)
    feature[at], value[at] = splits.feature[at], splits.value[at]
    return Forest(feature, value, max(float(_expected_path(sample)), 1e-9))


def grow_forest(
    points: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    trees: int = TREES,
    sample: int = SAMPLE,
    depth: int = DEPTH,
    seed: int = 7,
) -> Forest:
    """Trees that hold all points; splits are drawn from the box ``low`` to ``high``."""
    splits = draw_splits(low, high, trees, depth, seed)
    return forest_of(splits, splits.leaf_counts(points), sample)


def _rank(n: int, good_lost: float) -> int:
    """The place of the threshold among n good scores, from the least."""
    return int(np.ceil((n - 1) * (1 - good_lost)))


def threshold_for(scores: np.ndarray, good: np.ndarray, good_lost: float = GOOD_LOST) -> float:
    """The lowest threshold above which at most that share of the good rows lies."""
    chosen = np.sort(scores[good])
    return float(chosen[_rank(len(chosen), good_lost)])


def fit(stats: pd.DataFrame, seed: int = 7) -> tuple[Forest, float] | None:
    """Forest and threshold from labelled statistics that pass the base rules."""
    passed = stats[~_base_failed(stats)]
    good = passed["label"].to_numpy() == 1
    if not good.any() or good.all():
        return None
    points = features(passed)
    forest = grow_forest(points[good], points.min(axis=0), points.max(axis=0), seed=seed)
    return forest, threshold_for(forest.score(points), good)


def ranked_value(values: DataFrame, rank: int, bins: int = BINS) -> float:
    """The value at a place among all values of the only column, counted from the least.

    Values are counted in bins, and again in the bin of that place until it holds one value.
    """
    value = F.col(values.columns[0])
    low, high = values.agg(F.min(value), F.max(value)).first()
    while low < high:
        bin_ = F.floor((value - F.lit(low)) / F.lit(high - low) * bins)
        inside = values.filter(value.between(low, high))
        found = inside.groupBy(F.least(bin_, F.lit(bins - 1)).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        )
        for row in sorted(found.collect()):
            low, high = row["low"], row["high"]
            if rank < row["n"]:
                break
            rank -= row["n"]
    return low


def fit_rows(known: DataFrame, seed: int = 7) -> tuple[Forest, float] | None:
    """What ``fit`` gives, from a table of labelled statistics that is counted in Spark."""
    passed = known.filter(
        (F.col("n_words") >= MIN_WORDS)
        & (100 * F.col("n_repeat_words") <= MOST_REPEATED_PERCENT * F.col("n_words"))
    )
    of_label = {r["label"]: r["count"] for r in passed.groupBy("label").count().collect()}
    if set(of_label) != {0, 1}:
        return None
    edges = passed.mapInPandas(_edges, "feature int, low double, high double")
    edges = edges.groupBy("feature").agg(F.min("low"), F.max("high")).orderBy("feature").collect()
    splits = draw_splits(np.array([r[1] for r in edges]), np.array([r[2] for r in edges]), seed=seed)
    good = passed.filter("label = 1")
    counts = good.mapInPandas(_counts_in(splits), "tree int, counts binary")
    counts = counts.groupBy("tree").applyInPandas(_counts_added, "tree int, counts binary")
    leaf_counts = np.zeros((len(splits.feature), 2**splits.depth), np.int64)
    for row in counts.collect():
        leaf_counts[row["tree"]] = np.frombuffer(row["counts"], "<i8")
    forest = forest_of(splits, leaf_counts)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"score": forest.score(features(batch))})

    scores = written(good.mapInPandas(scored, "score double"), "scores")
    return forest, ranked_value(scores, _rank(of_label[1], GOOD_LOST))


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            points = features(batch)
            yield pd.DataFrame(
                {
                    "feature": np.arange(points.shape[1]),
                    "low": points.min(axis=0),
                    "high": points.max(axis=0),
                }
            )


def _counts_in(splits: Splits):
    """A task's rows in the leaves of each tree."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(splits.feature), 2**splits.depth), np.int64)
        for batch in batches:
            counts += splits.leaf_counts(features(batch))
        if counts.any():
            packed = [c.astype("<i8").tobytes() for c in counts]
            yield pd.DataFrame({"tree": np.arange(len(counts)), "counts": packed})

    return counted


def _counts_added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(counts, "<i8") for counts in group["counts"])
    return pd.DataFrame({"tree": [group["tree"].iloc[0]], "counts": [total.tobytes()]})


def _base_failed(stats: pd.DataFrame) -> pd.Series:
    repeated = 100 * stats["n_repeat_words"] > MOST_REPEATED_PERCENT * stats["n_words"]
    return (stats["n_words"] < MIN_WORDS) | repeated


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
) -> DataFrame:
    """Rule statistics of each row and whether it is kept.

    One row of each labelled id takes part in growing and calibrating.
    """
    stats = written(rule_statistics(docs, text, doc_id), "rules")
    model = fit_rows(written(all_labelled_rows(stats, labels, label), "labelled"))

    def verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = model[0].score(features(batch)) if model else np.zeros(len(batch))
            result = batch[["doc_id", *STATS]].copy()
            result["base_failed"] = _base_failed(batch)
            result["anomaly"] = score
            odd = score > (model[1] if model else 1.0)
            result["kept"] = ~(result["base_failed"].to_numpy() | odd)
            yield result

    columns = ", ".join(f"{name} long" for name in STATS)
    return map_with_id(
        stats, verdicts, f"{columns}, base_failed boolean, anomaly double, kept boolean"
    )
