"""Classifier evaluation from one pass over the predictions.

Everything derives from the confusion matrix, a small aggregate; no metric reads the
predictions again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.operators.metrics import flatten_window, quotient, tumbling, units
from textpulse.schemas import CLASS_NAMES

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion_matrix(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Rows per actual and predicted class; class ids may be of any numeric type.

    ``weight`` names a count of rows, for predictions that are already aggregated.
    """
    return predictions.groupBy(
        *by,
        F.col(label).cast("int").alias("actual"),
        F.col(prediction).cast("int").alias("predicted"),
    ).agg(_rows(weight).alias("count"))


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def class_scores(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hits, support and predictions per class, then precision, recall and F1.

    Each cell of the matrix counts once for its actual and once for its predicted class.
    """
    n = F.col("count")
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("actual").alias("class_id"),
            n.alias("support"),
            zero.alias("predicted_count"),
            hit.alias("true_positives"),
        ),
        F.struct(
            F.col("predicted").alias("class_id"),
            zero.alias("support"),
            n.alias("predicted_count"),
            zero.alias("true_positives"),
        ),
    )
    counts = ("support", "predicted_count", "true_positives")
    per_class = (
        matrix.select(*by, F.inline(sides))
        .groupBy(*by, "class_id")
        .agg(*[F.sum(name).alias(name) for name in counts])
    )
    return _with_scores(per_class)


def _with_scores(per_class: DataFrame) -> DataFrame:
    precision = _or_zero(F.col("true_positives"), F.col("predicted_count"))
    recall = _or_zero(F.col("true_positives"), F.col("support"))
    harmonic = _or_zero(
        2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
    )
    return per_class.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", harmonic
    )


def evaluation_metrics(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by the support of each label."""
    scores = class_scores(confusion_matrix(predictions, label, prediction, by, weight), by)
    total = F.sum("support")
    weighted = [
        (F.sum(F.col("support") * F.col(name)) / total).alias(name)
        for name in ("precision", "recall", "f1")
    ]
    accuracy = (F.sum("true_positives") / total).alias("accuracy")
    return scores.groupBy(*by).agg(accuracy, *weighted, total.alias("rows"))


def classification_report(
    matrix: DataFrame, class_names: Sequence[str] = CLASS_NAMES
) -> DataFrame:
    """One row per named class, absent ones as zeros, with the printable report line."""
    spark = matrix.sparkSession
    zero = F.lit(0).cast("bigint")
    empty = spark.range(len(class_names)).select(
        F.col("id").cast("int").alias("class_id"),
        zero.alias("support"),
        zero.alias("predicted_count"),
        zero.alias("true_positives"),
    )
    counts = ("support", "predicted_count", "true_positives")
    scored = class_scores(matrix).select("class_id", *counts)
    named = F.element_at(F.array(*[F.lit(n) for n in class_names]), F.col("class_id") + 1)
    # Zero rows for every class stand in for an outer join with the class list.
    complete = (
        scored.filter(F.col("class_id").between(0, len(class_names) - 1))
        .unionByName(empty)
        .groupBy("class_id")
        .agg(*[F.sum(name).alias(name) for name in counts])
    )
    line = F.format_string(
        "%10s %10.3f %10.3f %10.3f %10d",
        F.col("class_name"),
        F.col("precision"),
        F.col("recall"),
        F.col("f1"),
        F.col("support"),
    )
    return (
        _with_scores(complete)
        .withColumn("class_name", named)
        .select("class_id", "class_name", "precision", "recall", "f1", "support")
        .withColumn("line", line)
    )


def report_text(report: DataFrame) -> DataFrame:
    """The whole report as one row of text; the lines are as few as the named classes."""
    head = F.concat(
        F.lit("Classification Report\n" + "=" * 50 + "\n"),
        F.format_string(
            "%10s %10s %10s %10s %10s\n",
            *[F.lit(t) for t in ("Class", "Precision", "Recall", "F1-Score", "Support")],
        ),
        F.lit("-" * 50 + "\n"),
    )
    lines = F.array_sort(F.collect_list(F.struct("class_id", "line")))
    body = F.array_join(F.transform(lines, lambda x: F.concat(x["line"], F.lit("\n"))), "")
    return report.agg(F.concat(head, body).alias("report"))


def compare_models(
    first: DataFrame,
    second: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Four metrics of two prediction sets side by side, and the winner by F1.

    Model 2 wins only if strictly better.
    """
    used = [label, prediction] if weight is None else [label, prediction, weight]
    tagged = first.select(F.lit(1).alias("model"), *used).unionByName(
        second.select(F.lit(2).alias("model"), *used)
    )
    metrics = evaluation_metrics(tagged, label, prediction, ["model"], weight)

    def of(model: int, name: str) -> Column:
        value = F.max(F.when(F.col("model") == model, F.col(name)))
        return F.coalesce(value, F.lit(0.0))

    side_by_side = metrics.agg(
        *[of(model, name).alias(f"{name}_{model}") for name in METRICS for model in (1, 2)]
    )
    winner = F.when(F.col("f1_2") > F.col("f1_1"), "Model 2").otherwise("Model 1")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(f"{name}_1").alias("model_1"),
                F.col(f"{name}_2").alias("model_2"),
                (F.col(f"{name}_2") - F.col(f"{name}_1")).alias("difference"),
                winner.alias("winner"),
            )
            for name in METRICS
        ]
    )
    return side_by_side.select(F.inline(rows))


def comparison_text(comparison: DataFrame, test_name: str) -> DataFrame:
    """The comparison as one row of text; it always has four lines."""
    titles = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1-Score"}
    title = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in titles.items()])
    rank = F.array_position(F.array(*[F.lit(k) for k in titles]), F.col("metric"))
    line = F.concat(
        title, F.format_string("%15.4f%15.4f%15.4f\n", "model_1", "model_2", "difference")
    )
    head = F.concat(
        F.lit(f"A/B Test Results: {test_name}\n" + "=" * 50 + "\n"),
        F.format_string(
            "Metric%15s%15s%15s\n", F.lit("Model 1"), F.lit("Model 2"), F.lit("Difference")
        ),
        F.lit("-" * 50 + "\n"),
    )
    lines = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "")
    end = F.concat(F.lit("\nWinner: "), F.max("winner"), F.lit("\n"))
    return comparison.agg(F.concat(head, body, end).alias("report"))


def with_correctness(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    correct = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return predictions.withColumn("correct_prediction", correct)


def windowed_evaluation(
    predictions: DataFrame,
    time: str = "kafka_timestamp",
    length: str = "5 minutes",
    weight: str | None = None,
    late_by: str | None = None,
) -> DataFrame:
    """Volume, accuracy and confidence per time window.

    On a stream ``late_by`` bounds the state; without it every window stays open.
    """
    if late_by is not None:
        predictions = predictions.withWatermark(time, late_by)
    if "correct_prediction" not in predictions.columns:
        predictions = with_correctness(predictions)
    total = _rows(weight)

    def summed(name: str) -> Column:
        return F.sum(name) if weight is None else F.sum(F.col(name) * F.col(weight))

    confidence = F.avg("confidence") if weight is None else summed("confidence") / total
    grouped = tumbling(predictions, time, length).agg(
        total.alias("total_predictions"),
        summed("correct_prediction").alias("correct_predictions"),
        (summed("correct_prediction") / total).alias("accuracy"),
        confidence.alias("avg_confidence"),
    )
    return flatten_window(grouped)


def evaluation_parts(
    predictions: DataFrame, time: str = "kafka_timestamp", length: str = "5 minutes"
) -> DataFrame:
    """What some predictions add to ``windowed_evaluation``, to be added up later.

    A column ``weight`` counts rows that are aggregated already.
    """
    weight = F.col("weight") if "weight" in predictions.columns else F.lit(1)
    correct = (F.col("label") == F.col("prediction")).cast("int")
    known = F.col("confidence").isNotNull().cast("int")
    grouped = tumbling(predictions, time, length).agg(
        F.sum(weight).cast("bigint").alias("total_predictions"),
        F.sum(F.coalesce(correct, F.lit(0)) * weight).cast("bigint").alias("correct"),
        F.sum(units(F.col("confidence")) * weight).cast("bigint").alias("confidence_sum"),
        F.sum(known * weight).cast("bigint").alias("confidence_n"),
    )
    return flatten_window(grouped)


def add_evaluation_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same windows as one."""
    added = ("total_predictions", "correct", "confidence_sum", "confidence_n")
    return parts.groupBy("window_start", "window_end").agg(
        *[F.sum(name).alias(name) for name in added]
    )


def merged_evaluation(parts: DataFrame) -> DataFrame:
    """``windowed_evaluation`` from parts; the confidence to six digits."""
    return add_evaluation_parts(parts).select(
        "window_start",
        "window_end",
        "total_predictions",
        F.col("correct").cast("double").alias("correct_predictions"),
        (F.col("correct") / F.col("total_predictions")).alias("accuracy"),
        quotient(F.col("confidence_sum"), F.col("confidence_n")).alias("avg_confidence"),
    )
