"""Cleaning and content extraction against golden rows and against the plain rule list."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textpulse.functions.text import clean_text, extract_content, long_enough

GOLDEN = [
    ("[EDIT: fixed] hello", "edit fixed hello"),
    ("TL;DR it is bad, imo", "tl dr it is bad, in my opinion"),
    ("see https://x.com/a/b?c=d#frag~z and or/and /r/tech u/me /u/me2", "see frag z and o"),
    ("café naïve — great!", "caf na ve great!"),
    ("a\x0bb\tc", "a b c"),
    ("IMHO great-ish imo's", "in my opinion great-ish in my opinion's"),
    ("", ""),
    (None, ""),
    (" \x01\t ", ""),
    ("gone [deleted] and [Removed]!", "gone and !"),
    ("u/r/x", "u"),
    ("u/foor/bar end", "end"),
    ("r/http://x", "r"),
    ("http[deleted]s://y z", "http s y z"),
    ("maximo éimo imo_ imo-x", "maximo in my opinion imo_ in my opinion-x"),
    ("http://" + "a" * 200_000, ""),
]


def cleaned(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    out = df.select("n", clean_text(F.col("t"), **options).alias("c")).orderBy("n").collect()
    return [row.c for row in out]


def test_golden_rows(spark):
    texts, expected = zip(*GOLDEN)
    assert cleaned(spark, texts) == list(expected)


def plain_rules(text: str) -> str:
    """The rules one after the other."""
    out = text.lower()
    for pattern in (
        r"\[deleted\]",
        r"\[removed\]",
        r"https?://[!$-_a-z]+",
        r"r/\w+",
        r"u/\w+",
        r"[^\w\s.,!?'-]",
    ):
        out = re.sub(pattern, " ", out, flags=re.ASCII)
    out = re.sub(r"\bimo\b", "in my opinion", out, flags=re.ASCII)
    out = re.sub(r"\bimho\b", "in my opinion", out, flags=re.ASCII)
    return re.sub(r"\s+", " ", out, flags=re.ASCII).strip()


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(11)
    pieces = [
        "r/", "u/", "/", "http://", "https://", "[deleted]", "[removed]", "[", "]", "imo", "imho",
        "a", "z9", "_", " ", "\t", "\n", "é", "漢", "'", "-", ".", "!", "#", "~", ";", "%41", "IMO",
        "R/", "U/", "HTTP://", "ü",
    ]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(6000)]


def test_merged_rules_equal_the_plain_list(spark, random_texts):
    assert cleaned(spark, random_texts) == [plain_rules(t) for t in random_texts]


def test_properties(spark, random_texts):
    once = cleaned(spark, random_texts)
    assert cleaned(spark, once) == once
    assert all(re.fullmatch(r"[a-z0-9_ .,!?'-]*", t) and "  " not in t for t in once)


def test_options(spark):
    assert cleaned(spark, ["[EDIT: fixed] hello"], strip_edit_notes=True) == ["hello"]
    assert cleaned(spark, ["Café — 漢字 naïve!"], unicode_words=True) == ["café 漢字 naïve!"]


def test_long_enough_is_strict(spark):
    df = spark.createDataFrame([("a" * 10,), ("a" * 11,), ("",)], "t string")
    assert [len(r.t) for r in df.filter(long_enough(F.col("t"), 10)).collect()] == [11]


def test_extract_content(spark):
    rows = [
        (" a title\x00\n", "x", "post", "a title"),
        (None, "x", "post", ""),
        (" \t", "x", "post", ""),
        ("[deleted]", None, "post", "[deleted]"),
        ("t", " a body ", "comment", "a body"),
        ("t", " [deleted]\n", "comment", ""),
        ("t", "[removed]", "comment", ""),
        ("t", None, "comment", ""),
        ("t", "b", "other", ""),
        ("t", "b", None, ""),
    ]
    df = spark.createDataFrame(rows, "title string, body string, kind string, expected string")
    wrong = df.filter(
        extract_content(F.col("title"), F.col("body"), F.col("kind")) != F.col("expected")
    )
    assert wrong.count() == 0
