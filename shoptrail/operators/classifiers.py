"""Classifiers on Spark ML and their scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting

_WEIGHT = "_weight"


def label_counts(train: DataFrame, label: str = "label") -> tuple[int, int]:
    row = train.agg(F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    if not row["n"] or not row["p"]:
        raise ValueError("training rows hold one class only")
    return row["n"], row["p"]


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def train_logistic(
    train: DataFrame, features: Sequence[str], label: str = "label",
    C: float = 1.0, penalty: str = "l2", max_iter: int = 200,
) -> PipelineModel:
    """Class-balanced logistic regression. ``C`` weighs the summed loss, so the penalty on the
    mean loss is 1 / (C n); balanced weights add up to n."""
    negative, positive = label_counts(train, label)
    n = negative + positive
    weight = F.when(F.col(label) == 1, n / (2 * positive)).otherwise(n / (2 * negative))
    estimator = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol=_WEIGHT, maxIter=max_iter,
        regParam=1.0 / (C * n), elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False)
    return Pipeline(stages=[_assembler(features), estimator]).fit(train.withColumn(_WEIGHT, weight))


def _positive_weight(train: DataFrame, label: str, given: float | None) -> float:
    if given is not None:
        return float(given)
    negative, positive = label_counts(train, label)
    return negative / positive


def depthwise_settings(
    n_estimators: int = 300, learning_rate: float = 0.05, max_depth: int = 6, subsample: float = 0.8, colsample: float = 0.8,
    gamma: float = 0.0, min_child_weight: float = 1.0, reg_alpha: float = 0.0, reg_lambda: float = 1.0, scale_pos_weight: float = 1.0,
) -> boosting.Settings:
    """Trees grown level by level. A split has to gain more than ``gamma`` and to leave ``min_child_weight`` of second derivatives on
    both sides; ``reg_alpha`` and ``reg_lambda`` are the L1 and L2 terms of the leaf weights."""
    return boosting.Settings(
        n_estimators, learning_rate, max_depth=max_depth, subsample=subsample, colsample=colsample, gamma=gamma,
        min_child_weight=min_child_weight, reg_alpha=reg_alpha, reg_lambda=reg_lambda, scale_pos_weight=scale_pos_weight)


def leaf_limited_settings(
    n_estimators: int = 300, learning_rate: float = 0.05, num_leaves: int = 31, max_depth: int = -1, min_child_samples: int = 20,
    subsample: float = 0.8, colsample: float = 0.8, min_split_gain: float = 0.0, reg_alpha: float = 0.0, reg_lambda: float = 0.0,
    scale_pos_weight: float = 1.0,
) -> boosting.Settings:
    """Trees grown leaf by leaf: at most ``num_leaves``, at any depth unless ``max_depth`` is positive."""
    return boosting.Settings(
        n_estimators, learning_rate, max_depth=max_depth, num_leaves=num_leaves, subsample=subsample, colsample=colsample, gamma=min_split_gain,
        min_child_weight=1e-3, min_child_samples=min_child_samples, reg_alpha=reg_alpha, reg_lambda=reg_lambda, scale_pos_weight=scale_pos_weight)


def train_gbt_depthwise(
    train: DataFrame, features: Sequence[str], label: str = "label", scale_pos_weight: float | None = None, **params,
) -> boosting.BoostedTrees:
    """Boosted trees grown level by level, parameters as in ``depthwise_settings``; positive rows weigh as much as negative ones by default."""
    weight = _positive_weight(train, label, scale_pos_weight)
    return boosting.fit(train, features, label, depthwise_settings(scale_pos_weight=weight, **params))


def train_gbt_leaf_limited(
    train: DataFrame, features: Sequence[str], label: str = "label", scale_pos_weight: float | None = None, **params,
) -> boosting.BoostedTrees:
    """Boosted trees with a limit of leaves, parameters as in ``leaf_limited_settings``."""
    weight = _positive_weight(train, label, scale_pos_weight)
    return boosting.fit(train, features, label, leaf_limited_settings(scale_pos_weight=weight, **params))


def score(
    model: PipelineModel | boosting.BoostedTrees, rows: DataFrame, keep: Sequence[str] = ("user_id", "label"), threshold: float = 0.5,
) -> DataFrame:
    """Ids, label, probability of buying and 0/1 prediction."""
    if isinstance(model, boosting.BoostedTrees):
        scored = model.with_probability(rows.select(*dict.fromkeys([*keep, *model.features])), "_p")
    else:
        scored = model.transform(rows).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(*keep, F.col("_p").alias("probability"), (F.col("_p") >= threshold).cast("int").alias("prediction"))


def training_history(model: boosting.BoostedTrees, rows: DataFrame, label: str = "label") -> DataFrame:
    """(round, loss): mean log loss of a boosted model on given rows after each of its trees."""
    data = [(i + 1, float(v)) for i, v in enumerate(model.losses(rows, label))]
    return rows.sparkSession.createDataFrame(data, "round int, loss double")
