import pytest
from pyspark.sql import functions as F

from textpulse.functions.lexicon import Lexicon, lexicon_sentiment
from textpulse.operators.scoring import lexicon_scorer

SHORT = ("neutral", 0.5, 0.33)
TIE = ("neutral", 0.5, 0.6)
GOLDEN = [
    (None, SHORT),
    ("", SHORT),
    ("   \t   ", SHORT),
    ("good", SHORT),
    ("ab\U0001f600\U0001f600", TIE),
    ("ab\U0001f600", SHORT),
    ("good day to all", ("positive", 0.8, 0.75)),
    ("GOOD\nday\x0bto all", ("positive", 0.8, 0.75)),
    ("great love it here", ("positive", 0.8, 0.7999999999999999)),
    ("awful hate bad things", ("negative", 0.2, 0.85)),
    ("good good good day", ("positive", 0.8, 0.75)),
    ("great! is not a token", TIE),
    ("good and bad at once", TIE),
    ("good great love best and awful", ("positive", 0.8, 0.8999999999999999)),
    ("good great amazing awesome love excellent", ("positive", 0.8, 0.95)),
    ("bad terrible awful hate worst horrible garbage", ("negative", 0.2, 0.95)),
]


def test_golden_rows(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GOLDEN)], "n int, t string")
    got = df.select("n", lexicon_sentiment(F.col("t")).alias("r")).orderBy("n").collect()
    assert [tuple(row.r) for row in got] == [expected for _, expected in GOLDEN]


def test_scorer_on_cleaned_text_agrees_with_the_column(spark):
    texts = [(t,) for t, _ in GOLDEN if t == " ".join((t or "").lower().split())]
    df = spark.createDataFrame(texts, "t string")
    both = lexicon_scorer()(df, "t").withColumn("column", lexicon_sentiment(F.col("t")))
    assert both.count() > 5
    assert both.filter(F.col("sentiment_result") != F.col("column")).count() == 0


def test_own_lexicon(spark):
    lexicon = Lexicon(positive=("fine",), negative=(), positive_score=1.0, min_length=1)
    df = spark.createDataFrame([("fine",), ("good day",)], "t string")
    got = df.select(lexicon_sentiment(F.col("t"), lexicon).alias("r")).collect()
    assert [tuple(row.r) for row in got] == [("positive", 1.0, 0.75), TIE]


@pytest.mark.parametrize("word", ["", "Good", "two words", " x"])
def test_lexicon_words_are_checked(word):
    with pytest.raises(ValueError):
        Lexicon(positive=(word,))


def test_result_is_never_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(lexicon_sentiment(F.col("t")).alias("r")).first().r is not None
    # The optimizer relies on this to drop the branch for failed scores.
    assert not lexicon_scorer()(df, "t").schema["sentiment_result"].nullable
