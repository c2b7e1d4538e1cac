"""Word-list sentiment with lists that are tables: of any size, joined instead of spelled out.

The distinct words of each text are joined to the table of terms and counted by side. Texts
stay where they are: only words with the text's key move, and counts are reduced on the map
side. A word that a large share of the texts has meets one term, and Spark may split its side
of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.functions.lexicon import DEFAULT_LEXICON, Lexicon, verdict_of_counts
from textpulse.operators.scoring import Scorer

JOIN, BROADCAST = "join", "broadcast"


def _sides(terms: DataFrame) -> DataFrame:
    """(word, positive, negative) of each term; a word on both lists counts on both sides."""
    listed = terms.filter("word is not null and word <> ''").select(
        F.lower("word").alias("_word"),
        (F.col("polarity") == "positive").cast("int").alias("_p"),
        (F.col("polarity") == "negative").cast("int").alias("_n"),
    )
    return listed.groupBy("_word").agg(
        F.max("_p").alias("_positive"), F.max("_n").alias("_negative")
    )


def term_hits(
    rows: DataFrame, terms: DataFrame, keys: Sequence[str], text: str, plan: str = JOIN
) -> DataFrame:
    """Keys with the number of distinct positive and negative words of the text.

    ``keys`` tell rows apart. ``plan`` is ``"join"``, where Spark decides by the sizes it sees, or
    ``"broadcast"`` for a list that the caller knows to fit into every task's memory.
    """
    if plan not in (JOIN, BROADCAST):
        raise ValueError(f"plan is {JOIN!r} or {BROADCAST!r}, not {plan!r}")
    sides = _sides(terms)
    words = F.explode(F.array_distinct(F.split(F.col(text), " "))).alias("_word")
    hits = rows.select(*keys, words).join(
        F.broadcast(sides) if plan == BROADCAST else sides, "_word"
    )
    return hits.groupBy(*keys).agg(
        F.sum("_positive").alias("_positive"), F.sum("_negative").alias("_negative")
    )


def term_scorer(
    terms: DataFrame,
    keys: Sequence[str],
    lexicon: Lexicon = DEFAULT_LEXICON,
    plan: str = JOIN,
) -> Scorer:
    """A scorer for cleaned texts by a table of ``word`` and ``polarity``.

    It gives what ``lexicon_scorer`` gives with the same words; scores and confidence are those
    of ``lexicon``, its own words are not used. ``keys`` have to tell rows apart.
    """

    def score(df: DataFrame, text: str) -> DataFrame:
        hits = term_hits(df, terms, keys, text, plan)
        renamed = hits.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_positive", "_negative")
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        zero = F.lit(0).cast("bigint")
        result = verdict_of_counts(
            F.col(text),
            F.coalesce("_positive", zero),
            F.coalesce("_negative", zero),
            lexicon,
            cleaned=True,
        )
        scored = df.join(renamed, same, "left").withColumn("sentiment_result", result)
        return scored.select(*df.columns, "sentiment_result")

    return score
