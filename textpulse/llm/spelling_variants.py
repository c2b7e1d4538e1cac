"""Group the words of a corpus with the frequent words that they may be misspellings of.

Words are counted over whole texts, and two words are near if they differ by exactly one
inserted, deleted or replaced code point. A word's form is its near word of largest count, if
that is at least ``ratio`` times its own; following forms leads to its root.

Near words are searched in bidirectional suffix-rank indexes (``suffix_search``) over the
delimited vocabulary. A word is split into two halves, one of which a near word has without
error. So the vocabulary is dealt out by halves: every word is posted under the beginnings and
ends that words of its own length, one less or one more would be split into, and is searched
for twice, once among the words that share its first half, the error being in the second, and
once the other way round, on mirrored words. A shard holds a bounded number of words; a half
that more words share is cut into several shards, each of which sees all its searches.

No pairs leave a shard: of each word, the number of its near words and the best of them do.
The two searches find different words, as the second leaves out what shares the first half.

Cases: null texts have no words, a null id counts as empty text in the hash. Rows are read one
by one, so repeated rows count again. Ties of a form go to the smallest word by code points.
A very long text is read whole; a very long word costs its four shards memory in proportion to
its length. An empty table gives no rows. Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import text_or_empty, written
from textpulse.llm.suffix_search import WordIndex, near_words

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
LEAST_COUNT = 2
RATIO = 10
# Every so many-th run by its hash loses a code point.
DAMAGED = 31

# Posted words that a shard holds about; the index takes some kilobytes for each.
WORDS_PER_SHARD = 16_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of the corpus that are long and frequent enough.

    Shorter runs are not taken out of the texts at all, as a run never becomes longer.
    """
    pattern = f"[{LETTERS}]{{{shortest},}}"
    runs = F.explode(F.regexp_extract_all(text_or_empty("text"), F.lit(pattern), F.lit(0)))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), runs.alias("_run")
    )
    rows = rows.select("_id", F.translate("_run", _UPPER, _UPPER.lower()).alias("_run"))
    digest = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    rows = rows.select("_run", digest.alias("_hash"))
    at = F.col("_hash") % F.length("_run")
    rows = rows.select("_run", "_hash", at.cast("int").alias("_at"))
    cut = F.expr("concat(substring(_run, 1, _at), substring(_run, _at + 2))")
    word = F.when(F.col("_hash") % DAMAGED == 0, cut).otherwise(F.col("_run"))
    counted = rows.select(word.alias("word")).filter(F.length("word") >= shortest)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _posted(words: DataFrame) -> DataFrame:
    """(side, half, word, n): every word under the halves that searches may come with."""
    near = F.array(*[F.length("word") + change for change in (-1, 0, 1)])
    firsts = F.array_distinct(F.transform(near, _half))
    seconds = F.array_distinct(F.transform(near, lambda size: size.cast("int") - _half(size)))
    sides = F.concat(
        F.transform(firsts, lambda k: F.struct(F.lit(0).alias("side"), k.alias("k"))),
        F.transform(seconds, lambda k: F.struct(F.lit(1).alias("side"), k.alias("k"))),
    )
    rows = words.select("word", "n", F.explode(sides).alias("_at"))
    half = F.when(F.col("_at.side") == 0, F.expr("left(word, _at.k)"))
    half = half.otherwise(F.expr("right(word, _at.k)"))
    return rows.select(F.col("_at.side").alias("side"), half.alias("half"), "word", "n")


def _searches(words: DataFrame) -> DataFrame:
    """(side, half, word): every word with its first half and with its second."""
    first = _half(F.length("word"))
    sides = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.select("word", first.alias("_k"), sides.alias("side"))
    half = F.when(F.col("side") == 0, F.expr("left(word, _k)"))
    half = half.otherwise(F.expr("right(word, length(word) - _k)"))
    return rows.select("side", half.alias("half"), "word")


_NO_MATCHES = pd.DataFrame(
    {
        "word": pd.Series([], dtype=object),
        "near": pd.Series([], dtype="int64"),
        "form": pd.Series([], dtype=object),
        "form_n": pd.Series([], dtype="int64"),
    }
)


def _shard_matches(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of one shard, reduced to a row per searched word that has any."""
    mirrored = bool(rows["side"].iloc[0])
    posted = rows[rows["n"].notna()].drop_duplicates("word").sort_values("word")
    words = posted["word"].tolist()
    counts = posted["n"].to_numpy(np.int64)
    searched = rows.loc[rows["n"].isna(), "word"].tolist()
    if not words or not searched:
        return _NO_MATCHES
    halves = [len(word) // 2 for word in searched]
    known = set(words)
    own = [word in known for word in searched]
    if mirrored:
        index = WordIndex([word[::-1] for word in words])
        exact = [len(word) - half for word, half in zip(searched, halves, strict=True)]
        pattern, match = near_words(index, [word[::-1] for word in searched], exact, own)
        # What shares the first half as well is found by the other search.
        fresh = [
            not words[m].startswith(searched[p][: halves[p]])
            for p, m in zip(pattern.tolist(), match.tolist(), strict=True)
        ]
        chosen = np.flatnonzero(fresh)
        pattern, match = pattern[chosen], match[chosen]
    else:
        pattern, match = near_words(WordIndex(words), searched, halves, own)
    if not len(pattern):
        return _NO_MATCHES
    # Words are in their order, so the least number is the least word.
    order = np.lexsort((match, -counts[match], pattern))
    pattern, match = pattern[order], match[order]
    first = np.flatnonzero(np.concatenate([[True], pattern[1:] != pattern[:-1]]))
    return pd.DataFrame(
        {
            "word": [searched[p] for p in pattern[first]],
            "near": np.diff(np.append(first, len(pattern))),
            "form": [words[m] for m in match[first]],
            "form_n": counts[match[first]],
        }
    )


def near_counts(words: DataFrame, words_per_shard: int = WORDS_PER_SHARD) -> DataFrame:
    """(word, n_near, best): near words of each word that has any, and the most frequent.

    ``words`` has distinct words with their counts ``n`` and has to be a written table, as it
    is read several times.
    """
    posted, searches = _posted(words), _searches(words)
    total = posted.count()
    shards = max(1, math.ceil(total / words_per_shard))
    # A half that fills more than one shard: at most one row for each shard's worth of words.
    hot = posted.groupBy("side", "half").agg(F.count(F.lit(1)).alias("_n"))
    hot = hot.filter(F.col("_n") > words_per_shard)
    hot = hot.select("side", "half", F.ceil(F.col("_n") / words_per_shard).alias("_cuts"))
    hot = written(hot, "hot-halves")
    home = F.pmod(F.xxhash64("side", "half"), F.lit(shards))
    cuts = F.coalesce("_cuts", F.lit(1))
    cut = F.pmod(F.xxhash64("word"), cuts)
    all_cuts = F.explode(F.sequence(F.lit(0).cast("long"), (cuts - 1).cast("long")))
    if hot.isEmpty():
        posted = posted.withColumn("_cut", F.lit(0).cast("long"))
        searches = searches.withColumn("_cut", F.lit(0).cast("long"))
    else:
        posted = posted.join(hot, ["side", "half"], "left").withColumn("_cut", cut)
        searches = searches.join(hot, ["side", "half"], "left").withColumn("_cut", all_cuts)
    # A cut of a hot half has a shard of its own.
    group = F.when(F.col("_hot"), F.xxhash64("side", "half", "_cut")).otherwise(home)
    columns = ["side", "word", "n", group.alias("_shard"), "_hot"]
    rows = posted.unionByName(searches.withColumn("n", F.lit(None).cast("long")), True)
    hot_row = F.col("_cuts").isNotNull() if "_cuts" in rows.columns else F.lit(False)
    rows = rows.withColumn("_hot", hot_row).select(*columns)
    found = rows.groupBy("side", "_hot", "_shard").applyInPandas(
        _shard_matches, "word string, near long, form string, form_n long"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("_less"), "form"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by jumps that double.

    Counts grow tenfold along a chain of forms, so few jumps are needed. A word is the form of
    at most as many words as can be near to it, so no key of the join is hot.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = links.join(further, "root", "left")
        jumped = jumped.select(
            "word",
            F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved"),
        )
        jumped = written(jumped, "roots")
        if jumped.filter("_moved").isEmpty():
            return jumped.select("word", "root")
        links = jumped.drop("_moved")


def spelling_variants(
    docs: DataFrame,
    *,
    shortest: int = SHORTEST,
    least: int = LEAST_COUNT,
    ratio: int = RATIO,
    words_per_shard: int = WORDS_PER_SHARD,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus."""
    words = written(word_counts(docs, shortest, least), "words")
    near = near_counts(words, words_per_shard)
    joined = words.join(near, "word", "left")
    form_n = -F.col("best._less")
    enough = form_n >= ratio * F.col("n")
    joined = joined.select(
        "word",
        F.when(enough, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, form_n).alias("form_n"),
    )
    joined = written(joined, "variants")
    roots = _rooted(joined.filter("form is not null"))
    result = joined.join(roots, "word", "left")
    return result.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
