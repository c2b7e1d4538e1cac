import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from textpulse.operators.evaluation import (
    classification_report,
    compare_models,
    comparison_text,
    confusion_matrix,
    evaluation_metrics,
    report_text,
    windowed_evaluation,
)
from textpulse.sources import tables as tb


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.range(5000).select(
        F.pmod(F.hash("id"), F.lit(3)).cast("double").alias("label"),
        F.pmod(F.hash("id", F.lit(7)), F.lit(4)).cast("double").alias("prediction"),
    )


def test_metrics_equal_golden_numbers_and_mllib(predictions):
    row = evaluation_metrics(predictions).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == pytest.approx(
        (0.249, 0.3286632621427884, 0.249, 0.28326976892541705), abs=1e-12
    )
    evaluator = MulticlassClassificationEvaluator()
    for name, value in (
        ("accuracy", row.accuracy),
        ("weightedPrecision", row.precision),
        ("weightedRecall", row.recall),
        ("f1", row.f1),
    ):
        assert evaluator.setMetricName(name).evaluate(predictions) == pytest.approx(value, abs=1e-12)


def test_labels_may_be_integers(predictions):
    ints = predictions.select(F.col("label").cast("int"), "prediction")
    same = confusion_matrix(ints).exceptAll(confusion_matrix(predictions))
    assert same.count() == 0


def test_report_covers_named_classes_only(spark):
    rows = [(0.0, 0.0)] * 1 + [(1.0, 0.0)] * 15 + [(7.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    report = classification_report(confusion_matrix(df)).orderBy("class_id")
    assert [tuple(r)[:6] for r in report.collect()] == [
        (0, "Negative", 0.0625, 1.0, pytest.approx(2 * 0.0625 / 1.0625), 1),
        (1, "Neutral", 0.0, 0.0, 0.0, 15),
        (2, "Positive", 0.0, 0.0, 0.0, 0),
    ]
    text = report_text(report).first().report
    assert text == (
        "Classification Report\n" + "=" * 50 + "\n"
        "     Class  Precision     Recall   F1-Score    Support\n" + "-" * 50 + "\n"
        "  Negative      0.063      1.000      0.118          1\n"
        "   Neutral      0.000      0.000      0.000         15\n"
        "  Positive      0.000      0.000      0.000          0\n"
    )


def test_comparison(spark, predictions):
    better = predictions.withColumn("prediction", F.col("label"))
    rows = {r.metric: r for r in compare_models(predictions, better).collect()}
    assert set(rows) == {"accuracy", "precision", "recall", "f1"}
    assert rows["accuracy"].difference == pytest.approx(1 - 0.249)
    assert {r.winner for r in rows.values()} == {"Model 2"}
    tie = compare_models(better, better)
    assert {r.winner for r in tie.collect()} == {"Model 1"}
    text = comparison_text(compare_models(predictions, better), "old against new").first().report
    assert text == (
        "A/B Test Results: old against new\n" + "=" * 50 + "\n"
        "Metric        Model 1        Model 2     Difference\n" + "-" * 50 + "\n"
        "Accuracy         0.2490         1.0000         0.7510\n"
        "Precision         0.3287         1.0000         0.6713\n"
        "Recall         0.2490         1.0000         0.7510\n"
        "F1-Score         0.2833         1.0000         0.7167\n"
        "\nWinner: Model 2\n"
    )


def test_windowed_evaluation(spark, predictions):
    timed = predictions.select(
        "label",
        "prediction",
        F.lit(0.5).alias("confidence"),
        F.timestamp_seconds(F.pmod(F.hash("label", "prediction"), F.lit(3)) * 300).alias(
            "kafka_timestamp"
        ),
    )
    got = windowed_evaluation(timed).collect()
    assert sum(r.total_predictions for r in got) == 5000
    assert sum(r.correct_predictions for r in got) == 0.249 * 5000
    for r in got:
        assert r.accuracy == r.correct_predictions / r.total_predictions
        assert r.avg_confidence == 0.5


def test_weights_stand_for_repeated_rows(spark, predictions):
    counted = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("weight"))
    same = confusion_matrix(counted, weight="weight").exceptAll(confusion_matrix(predictions))
    assert same.count() == 0
    assert evaluation_metrics(counted, weight="weight").first().f1 == pytest.approx(
        evaluation_metrics(predictions).first().f1
    )
    timed = predictions.withColumns(
        {
            "confidence": F.col("prediction") / 4,
            "kafka_timestamp": F.timestamp_seconds(F.col("label") * 300),
        }
    )
    some = timed.groupBy(*timed.columns).agg(F.count(F.lit(1)).alias("weight"))
    rows = [
        frame.orderBy("window_start").collect()
        for frame in (windowed_evaluation(timed), windowed_evaluation(some, weight="weight"))
    ]
    for plain, weighted in zip(*rows, strict=True):
        assert tuple(plain)[:2] == tuple(weighted)[:2]
        assert tuple(plain)[2:] == pytest.approx(tuple(weighted)[2:])


def test_weighted_join_counts_the_pairs_of_a_hot_key(spark):
    labels = spark.createDataFrame(
        [(n if n % 3 else 0, n % 2, n % 5 % 2) for n in range(90)],
        "doc_id long, quality int, toxic int",
    )
    documents = spark.createDataFrame([(n if n % 3 else 0,) for n in range(60)], "doc_id long")
    plain = tb.predictions(labels, documents).groupBy("doc_id", "label", "prediction").count()
    weighted = tb.weighted_predictions(labels, documents)
    assert sorted(map(tuple, weighted.collect())) == sorted(map(tuple, plain.collect()))
    assert sum(r.weight for r in weighted.collect()) > 400
