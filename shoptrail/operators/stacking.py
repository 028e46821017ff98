"""Aligning base predictions, stacking them and comparing models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import clip
from ..functions.draws import hash_cutoffs, hash_order
from ..session import materialize
from .classifiers import label_counts
from .contracts import require_columns, require_domain
from .dataset import stratified_split
from .metrics import evaluate_binary


def standardize_predictions(
    table: DataFrame, model: str, label: str = "label", probability: str = "probability", keys: Sequence[str] = ("user_id",),
) -> DataFrame:
    """(keys, label, ``<model>_prob``) as numbers; rows without either number are left out."""
    name = f"{model.lower()}_prob"
    numbers = table.select(*keys, F.col(label).try_cast("double").alias("label"), F.col(probability).try_cast("double").alias(name))
    return numbers.na.drop(subset=["label", name]).withColumn("label", F.col("label").cast("int"))


def to_user_level(predictions: DataFrame, probability: str) -> DataFrame:
    """Pair predictions as user predictions: the largest probability and label of the user."""
    return predictions.groupBy("user_id").agg(F.max("label").alias("label"), F.max(probability).alias(probability))


def align_predictions(logistic: DataFrame, xgboost: DataFrame, din: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """The three probabilities of samples all models scored, clipped away from 0 and 1."""
    keys = list(keys)
    merged = logistic.join(xgboost.drop("label"), keys).join(din.drop("label"), keys)
    merged = merged.na.drop(subset=["label", *K.BASE_PROBABILITIES])
    return merged.withColumns({c: clip(F.col(c), 1e-6, 1 - 1e-6) for c in K.BASE_PROBABILITIES})


def _both_labels(df: DataFrame) -> bool:
    row = df.agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    return row["low"] == 0 and row["high"] == 1


def split_by_label(df: DataFrame, keys: Sequence[str], percent: int = 70, seed: int = K.SEED) -> tuple[DataFrame, DataFrame]:
    """The first ``percent`` of each label in hash order, and the rest."""
    split = stratified_split(df, keys, percents=(percent, 0), seed=seed)
    return split.filter(F.col("split") == "train").drop("split"), split.filter(F.col("split") == "test").drop("split")


def split_by_hash(df: DataFrame, keys: Sequence[str], percent: int = 70, seed: int = K.SEED) -> tuple[DataFrame, DataFrame]:
    """The first ``percent`` of all rows in hash order, and the rest."""
    tagged = df.withColumn("_all", F.lit(1))
    counts = tagged.groupBy("_all").agg(F.count("*").alias("n"))
    quota = F.greatest(F.floor(F.col("n") * percent / 100), F.lit(1)).cast("bigint")
    cutoffs = hash_cutoffs(tagged, keys, counts.select("_all", quota.alias("quota")), ["_all"], seed)
    limit = cutoffs.select("cutoff").scalar()
    digest = hash_order(keys, seed)
    return df.filter(digest <= limit), df.filter(digest > limit)


@dataclass
class Stack:
    model: PipelineModel
    train: DataFrame
    test: DataFrame


def stack_models(merged: DataFrame, keys: Sequence[str] = ("user_id",), threshold: float = 0.5, seed: int = K.SEED) -> Stack:
    """Balanced logistic regression on the standardised base probabilities.

    The split is drawn again within the labels when a part lacks one of them.
    """
    merged = materialize(merged)
    train, test = split_by_hash(merged, keys, seed=seed)
    if not (_both_labels(train) and _both_labels(test)):
        train, test = split_by_label(merged, keys, seed=seed)
    negative, positive = label_counts(train)
    n = negative + positive
    weighted = train.withColumn("_weight", F.when(F.col("label") == 1, n / (2 * positive)).otherwise(n / (2 * negative)))
    stages = [
        VectorAssembler(inputCols=list(K.BASE_PROBABILITIES), outputCol="base"),
        StandardScaler(inputCol="base", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="_weight",
                           regParam=1.0 / n, maxIter=200, standardization=False),
    ]
    model = Pipeline(stages=stages).fit(weighted)

    def scored(rows):
        p = vector_to_array("probability")[1]
        return model.transform(rows).withColumn("_p", p).select(
            *rows.columns, F.col("_p").alias("stacking_prob"), (F.col("_p") >= threshold).cast("int").alias("stacking_prediction"))

    return Stack(model, scored(train), scored(test))


def compare_base_and_stacking(meta_test: DataFrame, probabilities: Sequence[str] = tuple(K.MODEL_LABELS), threshold: float = 0.5) -> DataFrame:
    """Metrics of every probability column as rows; all models go through one histogram."""
    long = meta_test.select("label", *probabilities).unpivot("label", list(probabilities), "_column", "probability")
    names = F.create_map(*[F.lit(x) for c in probabilities for x in (c, K.MODEL_LABELS.get(c, c))])
    named = long.select("label", "probability", names[F.col("_column")].alias("model"))
    metrics = evaluate_binary(named, by=["model"], threshold=threshold)
    return metrics.select("model", "auc", "accuracy", "precision", "recall", "f1")


def rank_models(metrics: DataFrame, by: str = "auc", name: str = "rank") -> DataFrame:
    """Models with their rank by a metric. The table has one row per model."""
    return metrics.withColumn(name, F.row_number().over(Window.orderBy(F.desc(by), "model")))


METRIC_COLUMNS = ("Accuracy", "Precision", "Recall", "F1", "ROC_AUC")


def model_comparison(tables: dict[str, DataFrame], position: str = "position") -> DataFrame:
    """The last test row of every metrics table, checked to lie in [0, 1], ranked by AUC."""
    rows = None
    for title, table in tables.items():
        require_columns(table, ["Dataset", position, *METRIC_COLUMNS])
        tests = table.filter(F.lower(F.trim("Dataset")) == "test")
        last = tests.agg(F.max_by(F.struct(*METRIC_COLUMNS), position).alias("m")).filter("m is not null")
        one = last.select(F.lit(title).alias("model"), *[F.col(f"m.{c}").alias(c) for c in METRIC_COLUMNS])
        rows = one if rows is None else rows.unionByName(one)
    require_domain(rows, unit_interval=METRIC_COLUMNS, min_rows=len(tables))
    return rank_models(rows, "ROC_AUC", "Rank")


def metrics_table(model_name: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Metrics rows (Model, Dataset, …, position) of scored data sets, as model reports keep them."""
    names = F.create_map(*[F.lit(x) for i, d in enumerate(parts) for x in (d, i)])
    scored = None
    for dataset, predictions in parts.items():
        tagged = predictions.select("label", "probability", F.lit(dataset).alias("Dataset"))
        scored = tagged if scored is None else scored.unionByName(tagged)
    metrics = evaluate_binary(scored, by=["Dataset"])
    return metrics.select(
        F.lit(model_name).alias("Model"), "Dataset", F.col("accuracy").alias("Accuracy"), F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"), F.col("f1").alias("F1"), F.col("auc").alias("ROC_AUC"), names[F.col("Dataset")].alias("position"))
