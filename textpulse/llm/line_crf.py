"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's score depends on statistics of the line itself and of the
lines before and after it; neighbouring labels are tied by transition scores. Forward-backward
gives each line's probability of being good, and the average weighted by line length, after
calibration, is the document's quality.

The field is fitted on a bounded sample of labelled documents whose lines all take the
document's label. Scoring goes batch by batch; documents of like line counts are swept together.

Cases: a null text counts as empty and is one empty line. Very long texts are read whole, in
pieces of their own. Repeated rows each get a result. Without labels of both kinds every
document gets the score 0.5. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import map_with_id, quoted
from textpulse.llm.training import fold, labelled_ids, one_label_each

FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3
MOST_LABELLED = 2_000
CHARS_AT_ONCE = 4_000_000

# Per line: constant, shares of symbols, marks, capitals, digits and bars, repeated and
# stuttering words, word length, blank, short, seen before.
OWN = 12
NEIGHBOURS = 2
WIDTH = OWN * (1 + NEIGHBOURS) + 2

_CLASSES = np.zeros(0x110000 // 16, np.uint8)
for _group, _chars in enumerate(
    ("#*$%&<>", "!?", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "|", "abcdefghijklmnopqrstuvwxyz"), 1
):
    _CLASSES[[ord(c) for c in _chars]] = _group
_CLASSES[0xC0:0xDF] = 3
_CLASSES[0xDF:0x100] = 6


@dataclass
class Lines:
    """Lines of a batch of documents, one after another."""

    features: np.ndarray  # a row per line, OWN columns
    weights: np.ndarray  # characters of each line, at least 1
    counts: np.ndarray  # lines of each document


def line_features(texts: list[str]) -> Lines:
    """Statistics of every line of every text."""
    counts = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    kinds = _CLASSES[np.minimum(codes, len(_CLASSES) - 1)]
    breaks = np.flatnonzero(codes == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(codes)]])
    totals = []
    for group in range(1, 7):
        at = np.flatnonzero(kinds == group)
        totals.append(np.searchsorted(at, ends) - np.searchsorted(at, starts))
    symbols, marks, upper, digits, bars, lower = (np.asarray(t, float) for t in totals)
    words, stutter, again, letters_in_words, seen_before = [], [], [], [], []
    for text in texts:
        seen: set[str] = set()
        for line in text.split("\n"):
            parts = line.split()
            n = len(parts)
            words.append(n)
            stutter.append(sum(map(str.__eq__, parts, parts[1:])))
            again.append(n - len(set(parts)))
            letters_in_words.append(sum(map(len, parts)))
            seen_before.append(n > 0 and line in seen)
            seen.add(line)
    words, stutter, again, chars = (
        np.asarray(x, float) for x in (words, stutter, again, letters_in_words)
    )
    n = np.maximum(words, 1)

    def bent(share: np.ndarray, half: float) -> np.ndarray:
        return share / (share + half)

    table = np.column_stack(
        [
            np.ones(len(n)),
            bent(symbols / n, 0.1),
            bent(marks / n, 0.1),
            # A few capitals are usual, more so in short lines.
            bent((upper / np.maximum(upper + lower, 1)) ** 2, 0.05),
            bent(digits / np.maximum(chars, 1), 0.1),
            bent(bars / n, 0.1),
            # Long lines repeat words anyway.
            again / n / (1 + np.log1p(n) / 5),
            bent(stutter / n, 0.1),
            chars / n / 10,
            words == 0,
            words < 5,
            np.asarray(seen_before, float),
        ]
    )
    return Lines(table.astype(np.float32), np.maximum(ends - starts, 1).astype(float), counts)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Features of each line, of the line before and of the line after."""
    table = lines.features
    last = np.cumsum(lines.counts) - 1
    first = last - lines.counts + 1
    before, after = np.zeros_like(table), np.zeros_like(table)
    before[1:] = table[:-1]
    after[:-1] = table[1:]
    before[first] = 0
    after[last] = 0
    edges = np.zeros((len(table), 2), np.float32)
    edges[first, 0] = 1
    edges[last, 1] = 1
    return np.hstack([table, before, after, edges])


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def _blocks(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Documents of like length together, so that padding at most doubles the lines."""
    order = np.argsort(counts, kind="stable")
    sizes = counts[order]
    begin = 0
    while begin < len(order):
        longest = 2 * sizes[begin]
        end = int(np.searchsorted(sizes, longest, side="right"))
        yield order[begin:end]
        begin = end


@dataclass(frozen=True)
class Field:
    """Weights of the state good against bad, and transitions [from, to]."""

    unary: np.ndarray
    transition: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def marginals(self, table: np.ndarray, counts: np.ndarray, pairs: np.ndarray | None = None):
        """Probability of good per line; ``pairs`` gains the expected transitions."""
        energy = table @ self.unary
        starts = np.cumsum(counts) - counts
        good = np.zeros(len(table))
        move = self.transition
        for docs in _blocks(counts):
            lengths = counts[docs]
            longest = int(lengths.max())
            where = starts[docs][:, None] + np.minimum(np.arange(longest), lengths[:, None] - 1)
            inside = np.arange(longest) < lengths[:, None]
            local = np.where(inside, energy[where], 0.0)
            n = len(docs)
            forward = np.zeros((longest, n, 2))
            backward = np.zeros((longest, n, 2))
            forward[0, :, 1] = local[:, 0]
            for t in range(1, longest):
                old = forward[t - 1]
                bad = _log_add(old[:, 0] + move[0, 0], old[:, 1] + move[1, 0])
                fine = _log_add(old[:, 0] + move[0, 1], old[:, 1] + move[1, 1]) + local[:, t]
                live = inside[:, t]
                forward[t, :, 0] = np.where(live, bad, old[:, 0])
                forward[t, :, 1] = np.where(live, fine, old[:, 1])
            total = _log_add(forward[-1, :, 0], forward[-1, :, 1])
            for t in range(longest - 2, -1, -1):
                live = inside[:, t + 1]
                bad, fine = backward[t + 1, :, 0], backward[t + 1, :, 1] + local[:, t + 1]
                backward[t, :, 0] = np.where(live, _log_add(move[0, 0] + bad, move[0, 1] + fine), 0)
                backward[t, :, 1] = np.where(live, _log_add(move[1, 0] + bad, move[1, 1] + fine), 0)
            chance = np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total, 0.0)).T
            good[where[inside]] = chance[inside]
            if pairs is not None and longest > 1:
                live = inside[:, 1:].T
                for a in (0, 1):
                    for b in (0, 1):
                        ahead = backward[1:, :, b] + (local[:, 1:].T if b else 0.0)
                        joint = np.exp(
                            np.minimum(forward[:-1, :, a] + move[a, b] + ahead - total, 0.0)
                        )
                        pairs[a, b] += joint[live].sum()
        return good

    def document_logit(self, lines: Lines) -> np.ndarray:
        """Log odds of the length-weighted share of good lines."""
        good = self.marginals(with_neighbours(lines), lines.counts)
        starts = np.cumsum(lines.counts) - lines.counts
        share = np.add.reduceat(good * lines.weights, starts) / np.add.reduceat(lines.weights, starts)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share))

    def score(self, lines: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.document_logit(lines) + self.intercept)))


def _calibrate(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression in one variable by Newton's method."""
    design = np.column_stack([logit, np.ones(len(logit))])
    weights = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - label) + 1e-3 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def fit_field(
    texts: list[str],
    labels: np.ndarray,
    odds: float | None = None,
    steps: int = 150,
    rate: float = 0.1,
    ridge: float = 1.0,
) -> Field | None:
    """Maximum likelihood with a ridge, by Adam over the whole sample.

    ``odds`` are those of a good document among all labelled ones, as the sample is balanced.
    """
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return None
    lines = line_features(texts)
    table = with_neighbours(lines).astype(float)
    truth = np.repeat(labels, lines.counts)
    steady = np.zeros((2, 2))
    for label in (0, 1):
        steady[label, label] = (lines.counts - 1)[labels == label].sum()
    unary, move = np.zeros(table.shape[1]), np.zeros((2, 2))
    moments = np.zeros((2, len(unary) + 4))
    for step in range(1, steps + 1):
        pairs = np.zeros((2, 2))
        good = Field(unary, move).marginals(table, lines.counts, pairs)
        gradient = np.concatenate([table.T @ (truth - good), (steady - pairs).ravel()])
        gradient = (gradient - ridge * np.concatenate([unary, move.ravel()])) / len(truth)
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        mean, spread = moments[0] / (1 - 0.9**step), moments[1] / (1 - 0.99**step)
        change = rate * mean / (np.sqrt(spread) + 1e-9)
        unary = unary + change[:-4]
        move = move + change[-4:].reshape(2, 2)
    field = Field(unary, move)
    slope, intercept = _calibrate(field.document_logit(lines), labels)
    if odds is not None:
        intercept += np.log(odds) - np.log(labels.sum() / (1 - labels).sum())
    return Field(unary, move, slope, intercept)


def score_texts(field: Field | None, texts: list[str | None]) -> np.ndarray:
    """Scores of many texts, a few million characters at once."""
    scores = np.full(len(texts), 0.5)
    if field is None:
        return scores
    begin, size = 0, 0
    whole = [text or "" for text in texts]
    for at, text in enumerate(whole):
        size += len(text)
        if size >= CHARS_AT_ONCE or at == len(whole) - 1:
            scores[begin : at + 1] = field.score(line_features(whole[begin : at + 1]))
            begin, size = at + 1, 0
    return scores


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    most_labelled: int = MOST_LABELLED,
) -> Field | None:
    """Fit on at most ``most_labelled`` documents of each label outside the held-out fold."""
    ids = labelled_ids(labels, label, most_labelled, folds=FOLDS, held_out=HELD_OUT)
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    # Bounded by the sample size. A repeated id gives its smallest text.
    rows = rows.join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = rows.toPandas().sort_values("doc_id")
    texts = [text or "" for text in sample["text"]]
    counts = one_label_each(labels, label).filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    good, bad = counts.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    return fit_field(texts, sample["label"].to_numpy(), (good or 0) / bad if bad else None)


def score_documents(
    docs: DataFrame, field: Field | None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Id, fold and score of each row."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "score": score_texts(field, list(batch["text"]))}
            )

    result = map_with_id(rows, scored, "score double")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return result.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """The rows that the classifier accepts, with all their columns."""
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(field, batch.column(place).to_pylist())
            yield batch.filter(pa.array(scores >= THRESHOLD))

    # As Arrow batches, so that no column changes its type on the way; by plain names, as
    # those of the input may hold dots.
    plain = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
