"""Text cleaning as built-in column expressions.

The work is dominated by regular expressions over whole texts, so the rules are merged as
far as their order allows, and a plain substring test spares those that cannot apply. A
text without a slash or an abbreviation takes one pass, which replaces everything outside
the kept alphabet. Mentions stay separate passes because removing one may expose or destroy
the other (``u/r/x``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.functions.binding import bind

# What counts as removable or replaceable text.
REMOVAL_MARKS = ("[deleted]", "[removed]")
# One character class, not an alternation: Java recurses per repetition of a group and
# overflows its stack on long links. The range from $ to _ takes in digits and / : ? = [ ].
LINK = r"https?://[!$-_a-z]+"
COMMUNITY_MENTION = r"r/\w+"
USER_MENTION = r"u/\w+"
NOT_KEPT = r"[^\w.,!?'-]+"
NOT_KEPT_UNICODE = r"[^\p{L}\p{M}\p{N}_.,!?'-]+"
OPINION = r"\bimh?o\b"
OPINION_TEXT = "in my opinion"
EDIT_NOTE = r"\[edit:\s*.*?\]"

# Java's String.trim removes everything up to and including the blank.
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


Step = Callable[[Column], Column]


def _where_contains(needles: tuple[str, ...], rewrite: Step) -> Step:
    """``rewrite`` for texts with one of the needles, others as they are."""

    def step(text: Column) -> Column:
        found = F.contains(text, F.lit(needles[0]))
        for needle in needles[1:]:
            found = found | F.contains(text, F.lit(needle))
        return F.when(found, rewrite(text)).otherwise(text)

    return step


def _replaced(*patterns: str, by: str = " ") -> Step:
    def step(text: Column) -> Column:
        for pattern in patterns:
            text = F.regexp_replace(text, pattern, by)
        return text

    return step


def _without_marks(text: Column) -> Column:
    for mark in REMOVAL_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return text


def cleaning_steps(
    *, strip_edit_notes: bool = False, unicode_words: bool = False
) -> list[Step]:
    """The steps in their order. Some use their text more than once."""
    notes = [_where_contains(("[edit:",), _replaced(EDIT_NOTE))] if strip_edit_notes else []
    return [
        F.lower,
        _where_contains(("[",), _without_marks),
        *notes,
        _where_contains(("/",), _replaced(LINK, COMMUNITY_MENTION, USER_MENTION)),
        _replaced(NOT_KEPT_UNICODE if unicode_words else NOT_KEPT),
        _where_contains(("imo", "imho"), _replaced(OPINION, by=OPINION_TEXT)),
        lambda text: F.coalesce(F.trim(text), F.lit("")),
    ]


def clean_text(text: Column, **options: bool) -> Column:
    """Lower-cased text without links, mentions, removal marks and special characters.

    Null gives an empty string. White space and special characters go in the same pass, as
    a run of either ends up as one blank. ``strip_edit_notes`` drops ``[edit: ...]`` notes;
    ``unicode_words`` keeps the letters of every script.
    """
    for step in cleaning_steps(**options):
        text = bind(text, step)
    return text


def clean_column(df: DataFrame, source: Column, target: str, **options: bool) -> DataFrame:
    """``clean_text`` as a chain of projections.

    Every step reads a finished column, so nothing is computed twice and, unlike with the
    single expression, all of it stays in whole-stage code generation.
    """
    df = df.withColumn(target, source)
    for step in cleaning_steps(**options):
        df = df.withColumn(target, step(F.col(target)))
    return df


def java_trim(text: Column) -> Column:
    return F.regexp_replace(text, JAVA_TRIM, "")


def extract_content(title: Column, body: Column, content_type: Column) -> Column:
    """The trimmed title of a post or body of a comment, else an empty string."""
    title, body = java_trim(title), java_trim(body)
    return F.coalesce(
        F.when(content_type == "post", title).when(
            (content_type == "comment") & ~body.isin(*REMOVAL_MARKS), body
        ),
        F.lit(""),
    )


def long_enough(text: Column, min_length: int) -> Column:
    """Strictly longer than ``min_length``."""
    return (text != "") & (F.length(text) > min_length)
