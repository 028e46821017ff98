"""Metrics of binary predictions, from one histogram of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio_or_null, safe_ratio
from ..functions.ordering import running_totals


def evaluate_binary(
    predictions: DataFrame, label: str = "label", probability: str = "probability",
    by: Sequence[str] = (), threshold: float = 0.5,
) -> DataFrame:
    """Counts, accuracy, precision, recall, F1 and AUC per group.

    Undefined precision, recall and F1 are 0; AUC of a single class is NaN. AUC adds, for every
    distinct score, the positives times the negatives below plus half of those level with it.
    """
    by = list(by)
    positive, score = F.col(label) == 1, F.col(probability)
    histogram = predictions.groupBy(*by, score.alias("_score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    cumulated = running_totals(histogram, ["_score"], ["neg"], by)
    hit = F.col("_score") >= threshold
    sums = cumulated.groupBy(*by).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)).alias("below"))
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "tp", "fp"))
    auc = F.coalesce(F.try_divide(F.col("below"), p.cast("double") * n), F.lit(float("nan")))
    return sums.select(
        *by, (p + n).alias("sample_count"), ratio_or_null(p, p + n).alias("positive_rate"),
        auc.alias("auc"), safe_ratio(tp + n - fp, p + n).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"), safe_ratio(tp, p).alias("recall"),
        safe_ratio(2 * tp, tp + fp + p).alias("f1"), safe_ratio(p - tp + fp, p + n).alias("error_rate"))


def pr_auc(predictions: DataFrame, label: str = "label", probability: str = "probability") -> float:
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=probability, labelCol=label, metricName="areaUnderPR", numBins=0)
    return float(evaluator.evaluate(predictions.select(F.col(label).cast("double").alias(label), probability)))


def roc_auc(predictions: DataFrame, label: str = "label", probability: str = "probability") -> float:
    """AUC as a number for the driver's search loops."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=probability, labelCol=label, metricName="areaUnderROC", numBins=0)
    return float(evaluator.evaluate(predictions.select(F.col(label).cast("double").alias(label), probability)))


def _confusion(predictions: DataFrame, label: str, probability: str, threshold: float):
    guess = F.col(probability) >= threshold
    actual = F.col(label) == 1
    return predictions.agg(
        F.count_if(~actual & ~guess).alias("tn"), F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"), F.count_if(actual & guess).alias("tp"))


def confusion_matrix(predictions: DataFrame, label: str = "label", probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    cells = _confusion(predictions, label, probability, threshold)
    return cells.select(F.inline(F.array(
        F.struct(F.lit(0).alias("label"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("label"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")))))


def classification_report(predictions: DataFrame, label: str = "label", probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def scores(hit, false_hit, missed):
        return F.struct(
            safe_ratio(hit, hit + false_hit).alias("precision"), safe_ratio(hit, hit + missed).alias("recall"),
            safe_ratio(2 * hit, 2 * hit + false_hit + missed).alias("f1"), (hit + missed).alias("support"))

    cells = _confusion(predictions, label, probability, threshold).select(
        scores(tn, fn, fp).alias("c0"), scores(tp, fp, fn).alias("c1"),
        safe_ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"))
    names = ("precision", "recall", "f1")
    zero, one = F.col("c0"), F.col("c1")
    support = zero["support"] + one["support"]

    def row(title, values, count):
        return F.struct(F.lit(title).alias("class"), *[v.alias(n) for n, v in zip(names, values)], count.alias("support"))

    weighted = [safe_ratio(zero[n] * zero["support"] + one[n] * one["support"], support) for n in names]
    return cells.select(F.inline(F.array(
        row("0", [zero[n] for n in names], zero["support"]),
        row("1", [one[n] for n in names], one["support"]),
        row("accuracy", [F.col("accuracy")] * 3, support),
        row("macro avg", [(zero[n] + one[n]) / 2 for n in names], support),
        row("weighted avg", weighted, support))))
