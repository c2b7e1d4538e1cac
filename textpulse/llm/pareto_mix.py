"""Mixing sources to target weights by Pareto order sampling.

Targets are in words: sources weigh 3, 1, 2, repeating by name, and share a multiple of all
words; a source's target stops at twice its words and the excess goes to the others by
weight. A document's expected copies are its source's target over the source's words. Whole
expected copies are certain; the fraction is an inclusion probability. Documents are ranked
by their random odds over their inclusion odds, and those of lowest rank are taken until the
words left of the target are used up. Sources, and with them documents, have unequal
probabilities; a weight column makes them unequal inside a source as well.

The random number is a digest of the id, so reruns agree. A source may hold most rows: its
ranks are cut into bins whose totals are summed first. Only the bin where the target is
reached is ranked row by row; bins before it are taken whole. A document that would cross
the target is passed over and the next round fills what is left with smaller ones.

Cases: a null text has no words and is never counted; a null source is a source of its own,
last in order. Null ids share one random number. Repeated rows are sampled each by itself. An
empty table gives an empty result. Other columns are not read; ``mix_rows`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import quoted, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
ROUNDS = 3
ROWS_PER_BIN = 20_000
SEED = "mix"

_TWO_52 = float(2**52)


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """Target of each source from its words; rows (source, source_size), one per source.

    Resharing the excess until no target is above its bound ends where every target is the
    smaller of its bound and one common level times its weight. Sources are put in the order
    in which they reach their bounds as the level rises; sums before and after each of them
    give the level, without a loop.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("_weight", table[nth.cast("int")])
    rows = rows.withColumn("_bound", MOST_COPIES * F.col("source_size").cast("double"))
    rows = rows.withColumn("_full_at", F.col("_bound") / F.col("_weight"))
    rising = Window.orderBy("_full_at", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("_bound").over(before), F.lit(0.0)).alias("_bound_before"),
        F.sum("_weight").over(onward).alias("_weight_onward"),
        (share * F.sum("source_size").over(everything)).alias("_all"),
    )
    # The level if just the sources before this one are full; the first that stays below its
    # own bound sets the true level.
    level = (F.col("_all") - F.col("_bound_before")) / F.col("_weight_onward")
    rows = rows.withColumn("_level", F.when(level <= F.col("_full_at"), level))
    rows = rows.withColumn("_true_level", F.first("_level", True).over(everything))
    target = F.least("_bound", F.coalesce(F.col("_true_level") * F.col("_weight"), F.col("_bound")))
    return rows.select("source", "source_size", target.alias("target"))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the key only."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / _TWO_52


def pareto_rank(random: Column, probability: Column) -> Column:
    """Random odds over inclusion odds; the lowest ranks are taken."""
    return (random / (1 - random)) / (probability / (1 - probability))


def _take(rows: DataFrame, bins: int) -> DataFrame:
    """Take rows by rank until ``_left`` words of their source are used; adds ``_taken``."""
    # Ranks scaled by the source's own odds spread evenly over (0, 1), whatever those are.
    even = F.col("_rank") * F.col("_odds")
    rows = rows.withColumn("_bin", F.floor(even / (1 + even) * bins).cast("long"))
    open_rows = rows.filter(~F.col("_in") & (F.col("size") <= F.col("_left")))
    totals = open_rows.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_bin")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("_s"),
        F.col("_bin").alias("_b"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"),
        "_words",
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b"))
    rows = rows.join(totals, same, "left").drop("_s", "_b")
    fits = ~F.col("_in") & (F.col("size") <= F.col("_left"))
    whole = fits & (F.col("_before") + F.col("_words") <= F.col("_left"))
    at_cut = fits & ~whole & (F.col("_before") < F.col("_left"))
    rows = rows.withColumn("_at_cut", F.coalesce(at_cut, F.lit(False)))
    rows = rows.withColumn("_in", F.col("_in") | F.coalesce(whole, F.lit(False)))
    running = Window.partitionBy("source", "_bin").orderBy("_rank", "doc_id", "size", "_row")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.filter("_at_cut")
    cut = cut.withColumn("_in", F.col("_before") + F.sum("size").over(running) <= F.col("_left"))
    rows = rows.filter(~F.col("_at_cut")).unionByName(cut)
    return rows.drop("_bin", "_before", "_words", "_at_cut")


def _with_left(rows: DataFrame) -> DataFrame:
    """Words still to be taken of each source, as ``_left``."""
    taken = rows.groupBy("source").agg(
        F.sum(F.col("_certain") * F.col("size") + F.when(F.col("_in"), F.col("size")).otherwise(0))
        .alias("_so_far")
    )
    taken = taken.withColumnRenamed("source", "_s")
    rows = rows.join(taken, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    left = F.floor(F.col("target") - F.col("_so_far") + 0.5)
    return rows.withColumn("_left", F.greatest(left, F.lit(0))).drop("_so_far")


def _targets(
    rows: DataFrame, weights: tuple[float, ...], share: float
) -> tuple[DataFrame, int]:
    """Targets and weights of each source, written, and the number of bins of ranks."""
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("weight") * F.col("size")).alias("_weighted"),
        F.avg("weight").alias("_mean_weight"),
        F.count(F.lit(1)).alias("_rows"),
    )
    sources = written(sources, "mix-sources")
    targets = source_targets(sources.select("source", "source_size"), weights, share)
    targets = targets.join(
        sources.select(F.col("source").alias("_s"), "_weighted", "_mean_weight"),
        F.col("source").eqNullSafe(F.col("_s")),
    ).drop("_s")
    targets = written(targets.withColumnRenamed("source", "_s"), "mix-targets")
    bins = sources.agg((F.max("_rows") / ROWS_PER_BIN).alias("n")).first()["n"]
    return targets, max(16, int(bins or 0))


def _ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with their certain copies, and the rank by which one more is drawn."""
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    expected = F.when(
        F.col("_weighted") > 0, F.col("target") * F.col("weight") / F.col("_weighted")
    ).otherwise(0.0)
    rows = rows.withColumn("_expected", F.least(expected, F.lit(float(MOST_COPIES))))
    rows = rows.withColumn("_certain", F.floor("_expected").cast("long"))
    chance = F.col("_expected") - F.col("_certain")

    def proper(share: Column) -> Column:
        return F.least(F.greatest(share, F.lit(1e-9)), F.lit(1 - 1e-9))

    inside = proper(chance)
    typical = F.try_divide(F.col("target") * F.col("_mean_weight"), F.col("_weighted"))
    typical = proper(F.coalesce(typical - F.floor(typical), F.lit(0.5)))
    rows = rows.withColumn("_odds", typical / (1 - typical))
    rows = rows.withColumn("_rank", pareto_rank(uniform(F.col("doc_id")), inside))
    # Without a fraction, or without room for one more copy, or without words: never drawn.
    can = (F.col("_certain") < MOST_COPIES) & (chance > 1e-9) & (F.col("size") > 0)
    rows = rows.withColumn("_rank", F.when(can, F.col("_rank")))
    return rows.drop("_expected", "_weighted", "_mean_weight", "weight")


def _sampled(rows: DataFrame, targets: DataFrame, bins: int, rounds: int) -> DataFrame:
    """Rows (doc_id, source, size, weight, _row and more) with their number of copies.

    ``_limit`` holds the words that were left when a row was taken: one number for each round
    of a source that takes rows, as every round leaves less.
    """
    rows = _ranked(rows, targets).withColumn("_in", F.lit(False))
    rows = rows.withColumn("_limit", F.lit(None).cast("long"))
    drawn = rows.filter(F.col("_rank").isNotNull())
    others = rows.filter(F.col("_rank").isNull())
    # Each round uses the rows several times; from here on they are read and not made again.
    rows = written(drawn.unionByName(others), "mix")
    for _ in range(rounds):
        rows = _with_left(rows)
        able = F.col("_rank").isNotNull()
        rows = _take(rows.filter(able), bins).unionByName(rows.filter(~able), True)
        limit = F.coalesce("_limit", F.when(F.col("_in"), F.col("_left")))
        rows = rows.withColumn("_limit", limit).drop("_left")
        rows = written(rows, "mix")
    return rows.withColumn("_copies", F.col("_certain") + F.col("_in").cast("long"))


def _place() -> Column:
    """What rows of a source are taken by, in this order; nulls come first as in windows."""
    return F.struct("_rank", "doc_id", "size", "_row")


def _cuts(sampled: DataFrame) -> DataFrame:
    """The last row that each round of a source took, with the words that were left for it."""
    last = sampled.filter("_in").groupBy(F.col("source").alias("_of"), "_limit")
    last = last.agg(F.max(_place()).alias("last"))
    return last.groupBy("_of").agg(F.collect_list(F.struct("_limit", "last")).alias("_rounds"))


def _sized(docs: DataFrame, text: str, doc_id: str, source: str, weight: str | None, *more):
    chosen = F.lit(1.0) if weight is None else F.coalesce(quoted(weight).cast("double"), F.lit(0.0))
    return docs.select(
        quoted(doc_id).alias("doc_id"),
        quoted(source).alias("source"),
        word_count(quoted(text)).alias("size"),
        F.greatest(chosen, F.lit(0.0)).alias("weight"),
        F.monotonically_increasing_id().alias("_row"),
        *more,
    )


def mix_documents(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    *,
    weight: str | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Words that the mix takes of each row, with its source's size and target."""
    rows = written(_sized(docs, text, doc_id, source, weight), "mix-sizes")
    targets, bins = _targets(rows, weights, share)
    rows = _sampled(rows, targets, bins, rounds)
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("_copies") * F.col("size")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mix_rows(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    *,
    weight: str | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns.

    A round takes all rows up to a last one that have no more words than were left. So whole
    rows are held against the last ones of their source, and texts stay where they are.
    """
    whole = F.struct(*[quoted(name) for name in docs.columns]).alias("_input")
    rows = written(_sized(docs, text, doc_id, source, weight, whole), "mix-rows")
    targets, bins = _targets(rows.drop("_input"), weights, share)
    cuts = _cuts(_sampled(rows.drop("_input"), targets, bins, rounds))
    targets = targets.join(cuts, F.col("_s").eqNullSafe(F.col("_of")), "left").drop("_of")
    rows = _ranked(rows, written(targets, "mix-cuts"))
    taken = F.exists(
        "_rounds", lambda cut: (F.col("size") <= cut["_limit"]) & (_place() <= cut["last"])
    )
    taken = F.coalesce(F.col("_rank").isNotNull() & taken, F.lit(False))
    rows = rows.withColumn("_copies", F.col("_certain") + taken.cast("long")).filter("_copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return rows.select("_input", times.alias("_nth")).select("_input.*")
