"""Word-list sentiment: distinct positive against distinct negative words of a text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from textpulse.functions.binding import bind

# The default word lists and scores.
POSITIVE_WORDS = (
    "good", "great", "amazing", "awesome", "love", "excellent",
    "fantastic", "perfect", "wonderful", "best", "brilliant",
)
NEGATIVE_WORDS = (
    "bad", "terrible", "awful", "hate", "worst",
    "horrible", "disgusting", "stupid", "useless", "garbage",
)


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...] = POSITIVE_WORDS
    negative: tuple[str, ...] = NEGATIVE_WORDS
    positive_score: float = 0.8
    negative_score: float = 0.2
    neutral_score: float = 0.5
    base_confidence: float = 0.7
    confidence_per_word: float = 0.05
    max_confidence: float = 0.95
    tie_confidence: float = 0.6
    short_confidence: float = 0.33
    min_length: int = 5

    def __post_init__(self):
        for word in (*self.positive, *self.negative):
            if not word or word != word.lower() or word.split() != [word]:
                raise ValueError(f"lexicon words are single lower-case words, not {word!r}")

    def words(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.positive, *self.negative)))


DEFAULT_LEXICON = Lexicon()


def _word_array(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(word) for word in words]).cast("array<string>")


def lexicon_hits(
    text: Column, lexicon: Lexicon = DEFAULT_LEXICON, *, cleaned: bool = False
) -> Column:
    """The distinct lexicon words among the tokens of a text (``array_intersect`` is a set).

    Cleaned text is lower-case with single blanks; a one-character separator then spares
    the regular expression, which is most of the cost of tokenizing.
    """
    tokens = F.split(text, " ") if cleaned else F.split(F.lower(text), r"\s+")
    return F.array_intersect(tokens, _word_array(lexicon.words()))


def _too_short(text: Column, lexicon: Lexicon, cleaned: bool) -> Column:
    # The minimum counts UTF-16 units, of which characters outside the basic plane have two;
    # only texts that look short need the exact count.
    units = F.length(F.encode(text, "utf-16be")) / 2
    below = (F.length(text) < lexicon.min_length) & (units < lexicon.min_length)
    short = text.isNull() | below
    return short if cleaned else short | text.rlike(r"\A[\x00-\x20]*\z")


def verdict(
    text: Column, hits: Column, lexicon: Lexicon = DEFAULT_LEXICON, *, cleaned: bool = False
) -> Column:
    """Sentiment, score and confidence from the hits; never null."""
    positive = F.size(F.array_intersect(hits, _word_array(lexicon.positive)))
    negative = F.size(F.array_intersect(hits, _word_array(lexicon.negative)))
    return verdict_of_counts(text, positive, negative, lexicon, cleaned=cleaned)


def verdict_of_counts(
    text: Column,
    positive: Column,
    negative: Column,
    lexicon: Lexicon = DEFAULT_LEXICON,
    *,
    cleaned: bool = False,
) -> Column:
    """``verdict`` from the numbers of distinct words on each side."""

    def outcome(name: str, score: float, confidence: Column) -> Column:
        return F.struct(
            F.lit(name).alias("sentiment"),
            F.lit(score).cast("double").alias("sentiment_score"),
            confidence.cast("double").alias("confidence"),
        )

    def by_words(count: Column) -> Column:
        # In doubles, step and base apart: 2 hits give 0.7999999999999999.
        raw = F.lit(lexicon.base_confidence) + count * F.lit(lexicon.confidence_per_word)
        return F.least(raw, F.lit(lexicon.max_confidence))

    return (
        F.when(
            _too_short(text, lexicon, cleaned),
            outcome("neutral", lexicon.neutral_score, F.lit(lexicon.short_confidence)),
        )
        .when(
            F.coalesce(positive > negative, F.lit(False)),
            outcome("positive", lexicon.positive_score, by_words(positive)),
        )
        .when(
            F.coalesce(negative > positive, F.lit(False)),
            outcome("negative", lexicon.negative_score, by_words(negative)),
        )
        .otherwise(outcome("neutral", lexicon.neutral_score, F.lit(lexicon.tie_confidence)))
    )


def lexicon_sentiment(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Text to ``struct<sentiment, sentiment_score, confidence>``."""
    return bind(lexicon_hits(text, lexicon), lambda hits: verdict(text, hits, lexicon))
