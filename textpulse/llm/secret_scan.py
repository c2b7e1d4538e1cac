"""Secrets in texts, judged by who else has them across the corpus.

Every text is scanned for three kinds of base spans and for token-like candidates. Candidates
are hashed and counted over the whole corpus by distinct repositories and distinct owners: a
value that many owners or repositories have is a copied example, one that stays with an owner
or two and in a repository or two looks live. Repositories of one and the same text count once. Live-looking tokens outside the base spans become spans of the kind ``owned``.

Scanning is one narrow pass of built-in expressions; its small result is written, so that the
texts are read once. The counts are distinct counts that reduce on the map side. Judgements
return in an equi-join on the hash, whose hot partitions Spark may split.

Cases: a null text counts as empty; such rows have no spans. Rows without an owner have one
owner together; rows without a repository are told apart by their texts. Repeated rows each get their
result and count once. Very long texts are scanned whole, and a text of very many matches costs
little more than its matches. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import quoted, written

# The base patterns. Letters are spelled in both cases, as case folding would
# also take letters outside ASCII. Runs are maximal, so a minimum in the pattern drops the
# same runs as a later test of the length; only the assignment needs the test, because a
# match that is too short still uses up its text.
KEY_WORDS = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
ASSIGN_HEAD = rf"""(?:{KEY_WORDS})["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")
MIN_ASSIGNED = 6

# What may be a credential without a key word: a long run with letters and digits in it.
CANDIDATE = "[A-Za-z0-9_-]{20,}"
HAS_BOTH = "[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"

MAX_OWNERS = 2
MAX_REPOSITORIES = 2

_SPANS = "array<struct<start:int,end:int,value:string>>"


# Matches whose positions are added up together; a text has a list of such runs.
_RUN = 256


def _pieces(text: Column, pattern: str) -> Column:
    """The matches with the lengths of the texts before them.

    Pieces between matches and the matches themselves alternate. Texts without a match are
    spared the second and third pass.
    """
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)),
        matches,
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    none = F.expr("cast(array() as array<struct<gap:int,value:string>>)")
    return F.when(text.rlike(pattern), pairs).otherwise(none)


def _total(pairs: Column) -> Column:
    return F.aggregate(
        pairs, F.lit(0), lambda at, pair: at + pair["gap"] + F.length(pair["value"])
    )


def _placed(pairs: Column, begin: Column) -> Column:
    """Spans of a run of pairs; the list that grows with them stays as short as a run."""
    start = F.struct(begin.alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + pair["gap"]
        end = first + F.length(pair["value"])
        span = F.struct(first.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(
            end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")
        )

    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def found(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Rows with the spans of each pattern in a column of its own instead of the text.

    Spans are leftmost matches that do not overlap, with code point positions, end exclusive.
    Lengths add up to positions: first within runs of matches, then over the runs, so that a
    text of very many matches costs little more than its matches. Each step is a column, as
    the next one uses it more than once.
    """
    kept = [name for name in rows.columns if name != text]
    rows = rows.select(
        *kept, *[_pieces(F.col(text), pattern).alias(name) for name, pattern in patterns.items()]
    )
    runs = {}
    for name in patterns:
        count = F.ceil(F.size(name) / _RUN).cast("int")
        numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1))
        numbers = F.coalesce(numbers, F.expr("cast(array() as array<int>)"))
        runs[name] = _runs_of(name, numbers)
    rows = rows.withColumns(runs)
    rows = rows.withColumns({f"{name}_sizes": F.transform(name, _total) for name in patterns})
    return rows.select(*kept, *[_all_placed(name).alias(name) for name in patterns])


def _runs_of(name: str, numbers: Column) -> Column:
    return F.transform(numbers, lambda n: F.slice(F.col(name), n * _RUN + 1, F.lit(_RUN)))


def _all_placed(name: str) -> Column:
    def placed(run: Column, n: Column) -> Column:
        before = F.aggregate(F.slice(F.col(f"{name}_sizes"), F.lit(1), n), F.lit(0), lambda a, b: a + b)
        return _placed(run, before)

    return F.flatten(F.transform(F.col(name), placed))


def _assigned(value: Column) -> Column:
    return F.regexp_replace(value, "^" + ASSIGN_HEAD, "")


def _marked(spans: Column, order: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end")
        ),
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]),
    )
    return F.concat_ws(",", parts)


def scan(docs: DataFrame, text: str, doc_id: str, owner: str, repository: str) -> DataFrame:
    """Base spans and hashed candidates of each row; narrow, without the text."""
    rows = docs.select(
        quoted(doc_id).alias("_id"),
        quoted(owner).cast("string").alias("_owner"),
        quoted(repository).cast("string").alias("_repository"),
        F.coalesce(quoted(text), F.lit("")).alias("_text"),
    )
    rows = rows.select(
        "_id",
        "_owner",
        "_repository",
        F.xxhash64("_text").alias("_key"),
        "_text",
    )
    patterns = {"_assign": ASSIGN, "_access": ACCESS, "_hex": HEX, "_tokens": CANDIDATE}
    rows = found(rows, "_text", patterns)
    long_enough = F.filter(
        F.col("_assign"), lambda s: F.length(_assigned(s["value"])) >= MIN_ASSIGNED
    )
    rows = rows.withColumn("_assign", long_enough)
    base = F.concat(
        _marked(F.col("_assign"), 0), _marked(F.col("_access"), 1), _marked(F.col("_hex"), 2)
    )
    rows = rows.withColumn("_base", base)
    values = F.concat(
        F.transform(F.col("_assign"), lambda s: s.withField("value", _assigned(s["value"]))),
        F.col("_access"),
        F.col("_hex"),
        F.filter(F.col("_tokens"), lambda s: s["value"].rlike(HAS_BOTH)),
    )
    candidates = F.transform(
        values,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.sha2(s["value"], 256).alias("hash"),
        ),
    )
    return rows.select(
        "_id",
        "_owner",
        "_repository",
        "_key",
        F.size("_assign").cast("long").alias("n_assign"),
        F.size("_access").cast("long").alias("n_access"),
        F.size("_hex").cast("long").alias("n_hex"),
        "_base",
        candidates.alias("_candidates"),
    )


def ownership(scanned: DataFrame) -> DataFrame:
    """Distinct owners, and distinct repositories of distinct texts, of every candidate hash."""
    seen = scanned.select(
        "_owner", "_repository", "_key", F.explode("_candidates.hash").alias("hash")
    )
    # Nulls in a struct are counted.
    apart = F.struct("_repository", F.when(F.col("_repository").isNull(), F.col("_key")))
    counts = seen.groupBy("hash").agg(
        F.count_distinct(F.struct("_owner")).alias("owners"),
        F.count_distinct(apart).alias("_repositories"),
        F.count_distinct("_key").alias("_texts"),
    )
    few = F.least("_repositories", "_texts")
    return counts.select("hash", "owners", few.alias("repositories"))


def judged_values(
    scanned: DataFrame,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """(hash, owners, repositories, live) of every value."""
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    return ownership(scanned).withColumn("live", few)


def _apart(rows: DataFrame) -> DataFrame:
    """(_id, _key, start, end, hash, _apart): candidates, and whether no base span meets them.

    Spans of a row are put in order: a base span meets a candidate if it begins no later and
    ends after the candidate's start, or if it is the next to begin and does so before its end.
    """
    base = F.transform(
        "_base",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("string").alias("hash")
        ),
    )
    spans = rows.select("_id", "_key", F.explode(F.concat(base, F.col("_candidates"))).alias("_s"))
    spans = spans.select("_id", "_key", "_s.*").distinct()
    of_row = Window.partitionBy("_id", "_key")
    is_base = F.col("hash").isNull()
    before = of_row.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = of_row.orderBy(F.desc("start")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.max(F.when(is_base, F.col("end"))).over(before)
    following = F.min(F.when(is_base, F.col("start"))).over(after)
    spans = spans.withColumns({"_reached": reached, "_following": following})
    apart = F.coalesce(F.col("_reached") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("_following") >= F.col("end"), F.lit(True)
    )
    return spans.filter(~is_base).select("_id", "_key", "start", "end", "hash", apart.alias("_apart"))


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Spans of each row, and how many of its values look live or copied."""
    scanned = written(scan(docs, text, doc_id, owner, repository), "secrets")
    live = judged_values(scanned, max_owners, max_repositories)
    live = live.select("hash", F.col("live").alias("_live"))

    # Copies of a text under one id share their judgement.
    rows = scanned.filter(F.size("_candidates") > 0)
    judged = _apart(rows).join(live, "hash")
    own = F.when(
        F.col("_live") & F.col("_apart"),
        F.struct(F.col("start"), F.lit(3).alias("kind"), F.col("end")),
    )
    judged = judged.groupBy("_id", "_key").agg(
        F.array_sort(F.collect_set(own)).alias("_own"),
        F.count_distinct(F.when(F.col("_live"), F.col("hash"))).alias("n_live_values"),
        F.count_distinct(F.when(~F.col("_live"), F.col("hash"))).alias("n_copied_values"),
    )
    judged = judged.select(
        F.col("_id").alias("_its_id"),
        F.col("_key").alias("_its_key"),
        "_own",
        "n_live_values",
        "n_copied_values",
    )
    same = F.col("_id").eqNullSafe(F.col("_its_id")) & (F.col("_key") == F.col("_its_key"))
    result = scanned.join(judged, same, "left")
    none = F.slice(F.col("_base"), 1, 0)
    return result.select(
        F.col("_id").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.concat("_base", F.coalesce("_own", none))).alias("spans"),
        F.coalesce(F.size("_own"), F.lit(0)).cast("long").alias("n_owned"),
        F.coalesce("n_live_values", F.lit(0)).alias("n_live_values"),
        F.coalesce("n_copied_values", F.lit(0)).alias("n_copied_values"),
    )
