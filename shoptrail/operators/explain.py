"""Which features drive a model, and where it errs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.ordering import exact_quantiles, global_rank
from ..session import materialize
from .boosting import BoostedTrees
from .classifiers import score
from .joins import heavy_of, hot_key_join
from .metrics import evaluate_binary


def logistic_coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """(feature, coefficient, absolute_coefficient, direction), largest effect first."""
    values = [float(v) for v in model.stages[-1].coefficients.toArray()]
    if len(values) != len(features):
        raise ValueError("one feature name per coefficient is needed")
    rows = [(f, v, abs(v), K.PROMOTES if v >= 0 else K.INHIBITS) for f, v in zip(features, values)]
    schema = "feature string, coefficient double, absolute_coefficient double, direction string"
    return spark.createDataFrame(sorted(rows, key=lambda r: (-r[2], r[0])), schema)


def stacking_weights(model: PipelineModel, spark) -> DataFrame:
    values = [float(v) for v in model.stages[-1].coefficients.toArray()]
    rows = [(K.MODEL_LABELS[c], v, abs(v)) for c, v in zip(K.BASE_PROBABILITIES, values)]
    schema = "base_model string, stacking_coefficient double, absolute_coefficient double"
    return spark.createDataFrame(sorted(rows, key=lambda r: (-r[2], r[0])), schema)


def tree_model_importance(
    model: PipelineModel | BoostedTrees, test: DataFrame, features: Sequence[str], key: str = "user_id",
    label: str = "label", seed: int = K.SEED,
) -> DataFrame:
    """(feature, importance): loss of AUC when the feature's values are exchanged among all rows.

    Rows are numbered by key, and the values of each feature by a hash, in ranges without a one-task window; equal numbers meet.
    All exchanged copies are scored in one pass.
    """
    features = list(features)
    rows = materialize(test.select(key, label, *[F.col(f).cast("double").alias(f) for f in features]))
    place = materialize(global_rank(rows, [key], name="_at"))
    values = rows.select(key, *features).unpivot(key, features, "feature", "_value")
    drawn = values.select("feature", "_value", F.md5(F.concat_ws("|", F.col(key).cast("string"), "feature", F.lit(str(seed)))).alias("_h"))
    donors = global_rank(drawn, ["_h"], ["feature"], name="_at").select("feature", "_value", "_at")
    mixed = place.join(donors, "_at").withColumns({f: F.when(F.col("feature") == f, F.col("_value")).otherwise(F.col(f)) for f in features})
    columns = [label, "feature", *features]
    exchanged = rows.withColumn("feature", F.lit("")).select(*columns).unionByName(mixed.select(*columns))
    scored = score(model, exchanged, ["feature", label])
    aucs = evaluate_binary(scored, label, by=["feature"]).select("feature", "auc")
    base = aucs.filter(F.col("feature") == "").select("auc").scalar()
    return aucs.filter(F.col("feature") != "").select("feature", (base - F.col("auc")).alias("importance")).orderBy(
        F.desc("importance"), "feature")


def split_importance(model: BoostedTrees, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance) from the gains of the model's own splits."""
    rows = sorted(zip(features, model.importances(), strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def surrogate_importance(
    table: DataFrame, features: Sequence[str], probability: str, key: str = "user_id",
    trees: int = 150, depth: int = 8, leaf: int = 5, seed: int = K.SEED,
) -> DataFrame:
    """(feature, importance) of a forest that imitates another model's probability on all rows."""
    if len(features) < 2:
        raise ValueError("a surrogate needs at least 2 features")
    known = materialize(table.select(key, probability, *features).na.drop())
    if known.count() < 20:
        raise ValueError("a surrogate needs at least 20 rows")
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(known)
    forest = RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, labelCol=probability, featuresCol="features")
    values = forest.fit(vectors.select("features", probability)).featureImportances.toArray()
    rows = sorted(zip(features, map(float, values)), key=lambda r: (-r[1], r[0]))
    return table.sparkSession.createDataFrame(rows, "feature string, importance double")


def core_features(sources: dict[str, DataFrame]) -> DataFrame:
    """Importance tables (feature, importance) of several models, each scaled to its maximum."""
    combined = None
    for name, table in sources.items():
        part = table.select("feature", F.col("importance").cast("double").alias("importance"), F.lit(name).alias("source_model"))
        combined = part if combined is None else combined.unionByName(part)
    highest = F.max("importance").over(Window.partitionBy("source_model"))  # one row per feature
    scaled = combined.withColumn("_max", highest).withColumn(
        "_share", F.when(F.col("_max") > 0, F.col("importance") / F.col("_max")).otherwise(0.0))
    return scaled.groupBy("feature").agg(
        F.avg("_share").alias("mean_normalized_importance"), F.max("_share").alias("max_normalized_importance"),
        F.count_distinct("source_model").alias("model_count"),
        F.array_join(F.array_sort(F.collect_set("source_model")), ",").alias("source_models"),
    ).orderBy(F.desc("model_count"), F.desc("mean_normalized_importance"), "feature")


def with_error_type(predictions: DataFrame, probability: str = "stacking_prob", threshold: float = 0.5) -> DataFrame:
    guess = (F.col(probability) >= threshold).cast("int")
    kind = (F.when((F.col("label") == 0) & (guess == 1), K.FALSE_POSITIVE)
            .when((F.col("label") == 1) & (guess == 0), K.FALSE_NEGATIVE).otherwise(K.CORRECT))
    return predictions.withColumns({"stacking_prediction": guess, "error_type": kind})


def error_samples(predictions: DataFrame, probability: str = "stacking_prob", threshold: float = 0.5) -> DataFrame:
    """Wrong predictions with their absolute error, worst first."""
    wrong = with_error_type(predictions, probability, threshold).filter(F.col("error_type") != K.CORRECT)
    return wrong.withColumn("absolute_error", F.abs(F.col("label") - F.col(probability))).orderBy(F.desc("absolute_error"))


def cold_start_flag(predictions: DataFrame, threshold: int = 3, activity: str | None = None) -> DataFrame:
    """Users with at most ``threshold`` events: by an activity column, else by their rows here."""
    if activity is not None:
        flag = F.col(activity).try_cast("double") <= threshold
        return predictions.withColumn("cold_start_user", F.coalesce(flag, F.lit(False)))
    counts = materialize(predictions.groupBy("user_id").agg(F.count("*").alias("_n")))
    joined = hot_key_join(predictions, counts, "user_id", hot=heavy_of(counts, "user_id"))
    return joined.withColumn("cold_start_user", F.coalesce(F.col("_n") <= threshold, F.lit(False))).drop("_n")


def long_tail_flag(predictions: DataFrame, quantile: float = 0.2, popularity: str | None = None) -> DataFrame:
    """Items at or below a quantile of popularity: a column's over rows, else of rows per item."""
    if popularity is not None:
        valued = predictions.withColumn("_n", F.col(popularity).try_cast("double"))
        limit = exact_quantiles(valued, "_n", {"q": quantile}).scalar()
    else:
        counts = materialize(predictions.groupBy("item_id").agg(F.count("*").alias("_n")))
        limit = exact_quantiles(counts, "_n", {"q": quantile}).scalar()
        valued = hot_key_join(predictions, counts, "item_id", hot=heavy_of(counts, "item_id"))
    return valued.withColumn("long_tail_item", F.coalesce(F.col("_n") <= limit, F.lit(False))).drop("_n")


def scenario_metrics(flagged: DataFrame, probability: str = "stacking_prob", threshold: float = 0.5) -> DataFrame:
    """Metrics of all rows and of the cold, warm, tail and head rows.

    Every row counts in three scenarios; score histograms are summed map-side.
    """
    names = F.array(
        F.lit(K.SCENARIO_ALL),
        F.when(F.col("cold_start_user"), K.SCENARIO_COLD).otherwise(K.SCENARIO_WARM),
        F.when(F.col("long_tail_item"), K.SCENARIO_TAIL).otherwise(K.SCENARIO_HEAD))
    rows = flagged.select("label", probability, F.explode(names).alias("scenario"))
    metrics = evaluate_binary(rows, probability=probability, by=["scenario"], threshold=threshold)
    return metrics.select(
        "scenario", "sample_count", "positive_rate", "auc", "accuracy", "precision", "recall", "f1", "error_rate")
