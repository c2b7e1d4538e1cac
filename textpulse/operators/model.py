"""A trained text classifier, and a scorer that combines it with the lexicon."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.functions.lexicon import DEFAULT_LEXICON, Lexicon, lexicon_hits, verdict
from textpulse.operators.columns import evaluate_once
from textpulse.operators.scoring import Scorer
from textpulse.schemas import TRAINING

# The built-in training texts; label 0 negative, 1 neutral, 2 positive.
TRAINING_TEXTS = (
    (0, "this is terrible awful bad disappointing worst"),
    (0, "hate this so much completely useless garbage"),
    (0, "disgusting horrible stupid annoying waste time"),
    (0, "angry frustrated disappointed terrible experience"),
    (0, "worst decision ever made big mistake regret"),
    (0, "absolutely horrible terrible bad quality"),
    (0, "completely disagree wrong terrible idea"),
    (0, "downvote this garbage nonsense stupid"),
    (1, "okay not bad average nothing special typical"),
    (1, "fine normal regular standard acceptable"),
    (1, "neutral feeling about this reasonable"),
    (1, "decent enough moderate fair average"),
    (1, "could be better could be worse"),
    (1, "meh it's okay nothing exciting"),
    (1, "standard typical normal expected"),
    (2, "love this amazing great awesome fantastic excellent"),
    (2, "wonderful brilliant outstanding incredible perfect"),
    (2, "best thing ever highly recommend amazing"),
    (2, "fantastic great job well done impressive"),
    (2, "absolutely love this perfect amazing experience"),
    (2, "outstanding excellent brilliant wonderful quality"),
    (2, "upvote this amazing content great work"),
    (2, "thanks great helpful appreciate good job"),
)

# Size of the feature space and the regression's settings.
HASH_BUCKETS = 20000
MAX_ITERATIONS = 100
REGULARIZATION = 0.01
ELASTIC_NET = 0.8

# Score by class id, as the lexicon gives it for negative, neutral and positive.
SENTIMENT_BY_CLASS = ("negative", "neutral", "positive")


# Rows of a given table that a fit takes at most.
MOST_FITTED = 2_000


def training_rows(spark: SparkSession) -> DataFrame:
    """The built-in texts, in one partition: the fit makes many passes over few rows."""
    return spark.createDataFrame(list(TRAINING_TEXTS), TRAINING).coalesce(1)


def sentiment_pipeline(text: str = "text", label: str = "label") -> Pipeline:
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text, outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="kept_words"),
            HashingTF(inputCol="kept_words", outputCol="counts", numFeatures=HASH_BUCKETS),
            IDF(inputCol="counts", outputCol="weights"),
            LogisticRegression(
                featuresCol="weights",
                labelCol=label,
                maxIter=MAX_ITERATIONS,
                regParam=REGULARIZATION,
                elasticNetParam=ELASTIC_NET,
            ),
        ]
    )


def train(rows: DataFrame) -> PipelineModel:
    """Fit on any frame of ``label`` and ``text``."""
    return sentiment_pipeline().fit(rows)


def train_on_sample(rows: DataFrame, order: str, most_rows: int = MOST_FITTED) -> PipelineModel:
    """Fit on at most ``most_rows`` rows of ``label`` and ``text``: those whose ``order`` hashes lowest.

    A bounded sample, and a random one, as ids often follow time or source. The fit makes many
    passes, so its rows are brought together and kept.
    """
    lowest = rows.orderBy(F.xxhash64(order), order).limit(most_rows)
    sample = lowest.select("label", "text").coalesce(1)
    sample.persist()
    try:
        return train(sample)
    finally:
        sample.unpersist()


_fitted: dict[str, PipelineModel] = {}


def default_model(spark: SparkSession) -> PipelineModel:
    """The model of the built-in texts, fitted once per application."""
    application = spark.sparkContext.applicationId
    if application not in _fitted:
        _fitted[application] = train(training_rows(spark))
    return _fitted[application]


_MODEL_COLUMNS = ("words", "kept_words", "counts", "weights", "rawPrediction")


def apply_model(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``prediction`` (class id) and ``probability`` (vector)."""
    renamed = df.withColumn("text", F.col(text)) if text != "text" else df
    scored = model.transform(renamed).drop(*_MODEL_COLUMNS)
    return scored.drop("text") if text != "text" and "text" not in df.columns else scored


def model_verdict(
    prediction: Column, probability: Column, lexicon: Lexicon = DEFAULT_LEXICON
) -> Column:
    """The class as a sentiment; the confidence is the probability of that class."""
    at = prediction.cast("int") + 1
    names = F.array(*[F.lit(name) for name in SENTIMENT_BY_CLASS])
    by_class = (lexicon.negative_score, lexicon.neutral_score, lexicon.positive_score)
    scores = F.array(*[F.lit(score).cast("double") for score in by_class])
    return F.struct(
        F.element_at(names, at).alias("sentiment"),
        F.element_at(scores, at).alias("sentiment_score"),
        F.array_max(vector_to_array(probability)).alias("confidence"),
    )


def model_scorer(model: PipelineModel) -> Scorer:
    def score(df: DataFrame, text: str) -> DataFrame:
        scored = apply_model(model, df, text)
        result = model_verdict(F.col("prediction"), F.col("probability"))
        return evaluate_once(scored, sentiment_result=result).drop("prediction", "probability")

    return score


def hybrid_scorer(model: PipelineModel, lexicon: Lexicon = DEFAULT_LEXICON) -> Scorer:
    """The lexicon's answer where it has a word of the text, else the model's."""

    def score(df: DataFrame, text: str) -> DataFrame:
        hits = lexicon_hits(F.col(text), lexicon, cleaned=True)
        scored = apply_model(model, evaluate_once(df, _hits=hits), text)
        by_lexicon = verdict(F.col(text), F.col("_hits"), lexicon, cleaned=True)
        by_model = model_verdict(F.col("prediction"), F.col("probability"), lexicon)
        result = F.when(F.size("_hits") > 0, by_lexicon).otherwise(by_model)
        return evaluate_once(scored, sentiment_result=result).drop(
            "_hits", "prediction", "probability"
        )

    return score
