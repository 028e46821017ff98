"""The stages from raw events to campaign evaluation, as functions of DataFrames.

A stage returns a dict of DataFrames (and fitted models where it trains). ``save_tables`` writes
such a dict. Only what later stages read many times is fixed with a checkpoint.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import events_between
from ..operators import activity, business, classifiers, cleaning, dataset, experiment, explain, explore
from ..operators import interaction, interest, marts, quality, rhythm, samples, sequences, stacking, tuning, wide
from ..operators.contracts import require_columns, require_non_empty, require_same_features
from ..operators.joins import attach_features, union_optional
from ..operators.metrics import classification_report, confusion_matrix, roc_auc
from ..session import materialize, stored
from ..sources import tables as io


def save_tables(results: dict, folder: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """Write every DataFrame of a stage result to ``folder/<name>``."""
    for name, value in results.items():
        if isinstance(value, DataFrame):
            io.write_parquet(value, f"{folder.rstrip('/')}/{name}", (partition_by or {}).get(name, ()))


# ---- data -------------------------------------------------------------------------------

def run_load_data(spark: SparkSession, path: str) -> DataFrame:
    return io.scan_csv_preview(spark, path)


def run_parallel_read(spark: SparkSession, path: str, out: str | None = None) -> DataFrame:
    """CSV without repeated or incomplete rows, optionally written as parquet."""
    clean = cleaning.drop_nulls(cleaning.dedup_rows(io.scan_csv_parallel(spark, path)))
    if out:
        io.write_parquet(clean, out)
        return spark.read.parquet(out)
    return clean


def run_clean_data(events: DataFrame) -> dict:
    require_columns(events, K.EVENT_COLUMNS)
    cleaned = cleaning.parse_time(cleaning.dedup_events(events), strict=True)
    return {"cleaned": cleaned, "quality_report": quality.quality_report(events)}


def run_build_feature_table(events: DataFrame) -> dict:
    return {
        "user_table": marts.user_table(events), "item_table": marts.item_table(events),
        "time_table": marts.time_table(events), "category_table": marts.category_table(events),
        "user_item_table": marts.user_item_table(events)}


def run_data_pipeline(events: DataFrame) -> dict:
    """Cleaned events, quality report and marts.

    Everything later reads the cleaned events, so they are written once as parquet, dealt and sorted by time: later stages read
    only their columns, and filters on time skip row groups by their statistics.
    """
    cleaned = run_clean_data(events)
    order = ["time", "user_id", "item_id"]
    cleaned["cleaned"] = stored(cleaned["cleaned"].repartitionByRange(*order).sortWithinPartitions(*order))
    return {**cleaned, **run_build_feature_table(cleaned["cleaned"])}


def run_sqlite_analysis(events: DataFrame) -> dict:
    """The reports over the star schema; its tables are also published for SQL text."""
    star = marts.star_schema(events)
    io.publish_star_schema(star)
    fact, dim_item = star["fact_user_behavior"], star["dim_item"]
    return {
        **star, "total_behavior_count": activity.total_behavior_count(fact),
        "behavior_count": activity.behavior_count(fact), "behavior_ratio": activity.behavior_ratio(fact),
        "daily_active_users": activity.daily_active_users(fact), "weekly_active_users": activity.weekly_active_users(fact),
        "hot_items_top10": activity.hot_items(fact), "hot_categories_top10": activity.hot_categories(fact, dim_item),
        "behavior_sequence": activity.behavior_sequence(fact), "funnel": activity.funnel_users(fact),
        "user_group": activity.user_group(fact), "repurchase_rate_top10": activity.repurchase_rate_top(fact)}


def run_exploratory_analysis(events: DataFrame) -> dict:
    segments = materialize(explore.rfm_segment(events))
    return {
        "behavior_count": activity.behavior_count(events).orderBy("behavior_type"),
        "daily_active_users": activity.daily_active_users(events),
        "weekly_active_users": activity.weekly_active_users_period(events),
        "hour_distribution": explore.hour_distribution(events), "hour_conversion_rate": explore.hour_conversion_rate(events),
        "conversion_funnel": explore.conversion_funnel(events), "drop_rate": explore.drop_rate(events),
        "rfm_segment": segments, "segment_count": explore.segment_count(segments),
        "segment_behavior": explore.segment_behavior(events, segments),
        "top_items": activity.hot_items(events, 20), "top_categories": activity.top_categories(events, 20),
        "category_conversion_rate": explore.category_conversion_rate(events),
        "repurchase_overall": explore.repurchase_overall(events),
        "top_repurchased_items": explore.top_repurchased_items(events),
        "day_type_behavior": explore.day_type_behavior(events), "summary": explore.eda_summary(events)}


# ---- features ---------------------------------------------------------------------------

run_time_features = rhythm.time_features
run_user_lifecycle_features = rhythm.user_lifecycle_features
run_item_lifecycle_features = rhythm.item_lifecycle_features
run_behavior_sequence_features = sequences.behavior_sequence_features
run_implicit_features = interaction.user_svd_features
run_business_features = business.business_features


def run_feature_preprocessing(time: DataFrame, sequence: DataFrame, business_table: DataFrame, svd: DataFrame | None = None) -> dict:
    """The wide table, its quality tables and its cleaned form."""
    table = materialize(wide.feature_table(time, sequence, business_table, svd))
    require_non_empty(table, "feature table")
    cleaned = wide.feature_table_cleaned(table)
    return {
        "feature_table": table, "feature_table_cleaned": cleaned, "missing_rate": quality.missing_rate(table),
        "unique_count": quality.unique_count(table), "quality_summary": quality.feature_quality_summary(table, cleaned)}


def run_build_model_dataset(
    features: DataFrame, events: DataFrame, label_days: int = 7, top: int = 30, trees: int = 100,
    fit_on_train: bool = False, with_smote: bool = True,
) -> dict:
    """Labelled, balanced, encoded, scaled, reduced and split rows, with ``user_id`` kept as the sample id.

    By default means and deviations come from all rows; ``fit_on_train`` takes them from the
    training split only.
    """
    labelled = dataset.history_filter(dataset.purchase_label(features, events, label_days), events, label_days)
    labelled = materialize(labelled)
    balanced = materialize(dataset.stratified_split(materialize(dataset.undersample_balanced(labelled))))
    fit = balanced.filter(F.col("split") == "train") if fit_on_train else None
    texts = [c for c in dataset.text_columns(balanced) if c != "split"]
    encoded = dataset.target_encode(balanced, texts, fit_on=fit).drop(*texts)
    fit_encoded = encoded.filter(F.col("split") == "train") if fit_on_train else None
    columns = dataset.numeric_columns(encoded)
    scaled = materialize(dataset.standardize(encoded, columns, fit_on=fit_encoded).select("user_id", "label", "split", *columns))
    importance = dataset.feature_importance_rf(scaled, columns, trees=trees)
    final = dataset.select_top_features(scaled, importance, top, ("user_id", "label", "split"))
    chosen = [c for c in final.columns if c not in ("user_id", "label", "split")]
    train = final.filter(F.col("split") == "train")
    result = {
        "labelled": labelled, "balanced": balanced, "final": final, "feature_importance": importance,
        "label_correlation": dataset.label_correlation(scaled, columns),
        "class_weights": dataset.class_weights(train), "scale_pos_weight": dataset.scale_pos_weight(train),
        "features": chosen,
        "summary": dataset.dataset_summary({"labelled": labelled, "balanced": balanced, "train": train}, events, label_days)}
    if with_smote:
        result["train_smote"] = dataset.smote_oversample(train, chosen)
    return result


def run_feature_pipeline(events: DataFrame, label_days: int = 7, as_of=True, with_svd: bool = True, **options) -> dict:
    """All user features and the model dataset.

    Features see events up to ``as_of``: by default the day before the label window, else a date column; None takes all events,
    and then the label window leaks into the features.
    """
    from ..functions.columns import events_up_to, last_day

    if as_of is True:
        as_of = F.date_sub(last_day(events), label_days)
    seen = events if as_of is None else events_up_to(events, as_of)
    tables = {
        "time_features": run_time_features(seen), "user_lifecycle_features": run_user_lifecycle_features(seen),
        "item_lifecycle_features": run_item_lifecycle_features(seen),
        "behavior_sequence_features": run_behavior_sequence_features(seen),
        "business_features": run_business_features(seen)}
    if with_svd:
        tables["user_svd_features"] = run_implicit_features(seen)
    prepared = run_feature_preprocessing(
        tables["time_features"], tables["behavior_sequence_features"], tables["business_features"],
        tables.get("user_svd_features"))
    built = run_build_model_dataset(prepared["feature_table_cleaned"], events, label_days, **options)
    return {**tables, **prepared, **{f"dataset_{k}" if k == "summary" else k: v for k, v in built.items()}}


# ---- models -----------------------------------------------------------------------------

def _splits(final: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(final.filter(F.col("split") == s).drop("split") for s in ("train", "valid", "test"))


def _model_stage(name: str, fit, search, final: DataFrame, features, trials: int, fit_options: dict, search_options: dict) -> dict:
    """Baseline, search, and metrics, report and confusion matrix of each part.

    The model with the larger AUC on the validation rows scores the test rows, the baseline at a tie.
    """
    train, valid, test = _splits(final)
    train, valid, test = cleaning.impute_train_median([train, valid, test], features)
    baseline = fit(train, features, **fit_options)
    parts = {"Validation": materialize(classifiers.score(baseline, valid))}
    best, found = baseline, None
    if trials:
        found = search(train, valid, features, trials=trials, **search_options)
        parts["Tuned validation"] = materialize(classifiers.score(found.best_model, valid))
        if roc_auc(parts["Tuned validation"]) > roc_auc(parts["Validation"]):
            best = found.best_model
    parts["Test"] = materialize(classifiers.score(best, test))

    def of_parts(table):
        return functools.reduce(DataFrame.unionByName, [table(rows).withColumn("dataset", F.lit(part)) for part, rows in parts.items()])

    result = {
        "model": best, "predictions": parts["Test"], "test": test, "metrics": stacking.metrics_table(name, parts),
        "classification_report": of_parts(classification_report), "confusion_matrix": of_parts(confusion_matrix),
        "importance": (explain.logistic_coefficients(best, features, final.sparkSession) if name == "Logistic Regression"
                       else explain.split_importance(best, features, final.sparkSession))}
    if found is not None:
        result["trials"] = found.trials
        result["best_params"] = final.sparkSession.createDataFrame(
            [(name, k, str(v)) for k, v in sorted(found.best_params.items())], "model string, parameter string, value string")
    return result


def run_logistic_regression(final, features, trials: int = 30, fit_options=None, search_options=None) -> dict:
    return _model_stage("Logistic Regression", classifiers.train_logistic, tuning.tune_logistic, final, features, trials,
                        fit_options or {}, search_options or {})


def run_xgboost(final, features, trials: int = 30, fit_options=None, search_options=None) -> dict:
    return _model_stage("XGBoost", classifiers.train_gbt_depthwise, tuning.tune_depthwise, final, features, trials,
                        fit_options or {}, search_options or {})


def run_lightgbm(final, features, trials: int = 30, fit_options=None, search_options=None) -> dict:
    return _model_stage("LightGBM", classifiers.train_gbt_leaf_limited, tuning.tune_leaf_limited, final, features, trials,
                        fit_options or {}, search_options or {})


def run_traditional_models(final: DataFrame, features, trials: int = 30, tree_options=None, search_options=None) -> dict:
    return {
        "logistic": run_logistic_regression(final, features, trials),
        "xgboost": run_xgboost(final, features, trials, tree_options, search_options),
        "lightgbm": run_lightgbm(final, features, trials, tree_options, search_options)}


def run_model_comparison(models: dict) -> DataFrame:
    titles = {"logistic": "Logistic Regression", "xgboost": "XGBoost", "lightgbm": "LightGBM"}
    return stacking.model_comparison({titles.get(k, k): m["metrics"] for k, m in models.items()})


def run_deep_learning_models(events: DataFrame, tree_options=None, svd_options=None, models: dict | None = None, **windows) -> dict:
    """Sequence samples, interest features on item factors, and pair predictions.

    Item factors come from events before the training cutoff only. With the results of ``run_traditional_models`` their metrics
    stand beside these in ``comparison``.
    """
    spans = {k: windows[k] for k in ("history_days", "label_days") if k in windows}
    cutoff = samples.choose_cutoffs(events, **spans).select("train_cutoff").scalar()
    first = F.to_date(events.select(F.min("time")).scalar())
    factors = interaction.factorize(events_between(events, first, cutoff), **(svd_options or {}))
    pairs = samples.build_time_split_dataset(events, **windows)
    ready = materialize(interest.interest_features(pairs, factors.items))
    model = interest.train_interest_model(ready, **(tree_options or {}))
    scored = materialize(interest.score_interest(model, ready))
    valid = interest.score_interest(model, ready, "val")
    result = {
        "samples": ready, "model": model, "predictions": scored,
        "history": classifiers.training_history(model, ready.filter(F.col("split") == "val")),
        "metrics": stacking.metrics_table("Interest", {"Validation": valid, "Test": scored})}
    if models:
        result["comparison"] = union_optional(result["metrics"], *[m["metrics"] for m in models.values()])
    return result


def run_explanation(models: dict, features, key: str = "user_id") -> dict:
    """Coefficients, loss of AUC by exchange and a surrogate of the second tree model, and the features they agree on."""
    logistic, xgboost, lightgbm = (models[m] for m in ("logistic", "xgboost", "lightgbm"))
    require_same_features(logistic["test"].select(*features), xgboost["test"].select(*features))
    coefficients = explain.logistic_coefficients(logistic["model"], features, logistic["test"].sparkSession)
    trees = explain.tree_model_importance(xgboost["model"], xgboost["test"], features, key)
    imitated = attach_features(lightgbm["predictions"].drop("label", "prediction"), lightgbm["test"].drop("label"), key)
    result = {"logistic_coefficients": coefficients, "tree_importance": materialize(trees)}
    sources = {"Logistic Regression": coefficients.withColumnRenamed("absolute_coefficient", "importance"), "XGBoost": result["tree_importance"]}
    if len(features) >= 2 and imitated.na.drop().limit(20).count() == 20:
        result["surrogate_importance"] = sources["LightGBM"] = explain.surrogate_importance(imitated, features, "probability", key)
    result["core_features"] = explain.core_features(sources)
    return result


def run_model_fusion(
    logistic: DataFrame, xgboost: DataFrame, din: DataFrame, features: DataFrame | None = None,
    user_activity: str | None = None, importances: dict[str, DataFrame] | None = None,
) -> dict:
    """Stacked probabilities, their weights, comparison and error analysis.

    The base predictions meet per user; ``din`` may hold (user, item) pairs, which then carry the user's stacked probability into
    the scenarios and ``pairs``, so that cold users and long-tail items can be told apart.
    """
    merged = stacking.align_predictions(
        stacking.standardize_predictions(logistic, "logistic"),
        stacking.standardize_predictions(xgboost, "xgboost"),
        stacking.to_user_level(stacking.standardize_predictions(din, "din"), "din_prob"))
    stack = stacking.stack_models(merged)
    test = materialize(stack.test)
    columns = [c for c in ("item_id", "item_category", "price") if c in din.columns]
    pairs = test if not columns else attach_features(din.select("user_id", *columns), test, "user_id").filter(F.col("stacking_prob").isNotNull())
    table = pairs if features is None else attach_features(pairs, features.drop("label"), "user_id")
    flagged = explain.cold_start_flag(table, activity=user_activity)
    flagged = explain.long_tail_flag(flagged) if "item_id" in columns else flagged.withColumn("long_tail_item", F.lit(False))
    flagged = materialize(flagged)
    result = {
        "merged": merged, "model": stack.model, "train": stack.train, "test": test, "pairs": flagged,
        "weights": explain.stacking_weights(stack.model, merged.sparkSession),
        "comparison": stacking.rank_models(stacking.compare_base_and_stacking(test)),
        "errors": explain.error_samples(flagged), "scenarios": explain.scenario_metrics(flagged)}
    if importances:
        result["core_features"] = explain.core_features(importances)
    return result


def run_business_ab_test(predictions: DataFrame, score: str = "stacking_prob", **columns) -> dict:
    """Units, targets, assignment, sizes, group metrics, effects, segments and categories."""
    units = materialize(experiment.experiment_units(predictions, score=score, **columns))
    targets = materialize(experiment.target_population(units))
    assigned = materialize(experiment.stratified_assignment(targets))
    sizes = experiment.experiment_days(experiment.required_sample_size(experiment.baseline_rate(assigned)), targets)
    metrics = experiment.group_metrics(assigned, "price" if "price" in assigned.columns else None)
    result = {
        "units": units, "assignment": assigned, "sizes": sizes, "group_metrics": metrics,
        "effect_summary": experiment.effect_summary(metrics, sizes),
        "score_segments": experiment.score_segment_analysis(assigned)}
    # without categories, all units form one
    named = assigned if "item_category" in assigned.columns else assigned.withColumn("item_category", F.lit(None).cast("int"))
    result["category_recommendations"] = experiment.category_recommendations(named)
    return result


def run_full_pipeline(
    events: DataFrame, label_days: int = 7, trials: int = 30, tree_options=None, search_options=None,
    svd_options=None, windows=None, feature_options=None,
) -> dict:
    """Events to campaign evaluation."""
    data = run_data_pipeline(events)
    cleaned = data["cleaned"]
    features = run_feature_pipeline(cleaned, label_days, **(feature_options or {}))
    models = run_traditional_models(features["final"], features["features"], trials, tree_options, search_options)
    explanation = run_explanation(models, features["features"])
    interests = run_deep_learning_models(cleaned, tree_options, svd_options, models, **(windows or {}))
    fusion = run_model_fusion(
        models["logistic"]["predictions"], models["xgboost"]["predictions"], interests["predictions"],
        features["time_features"].select("user_id", "total_behavior_count"), "total_behavior_count")
    columns = {"item": "item_id", "category": "item_category", "price": "price"}
    campaign = run_business_ab_test(fusion["pairs"], **{k: c for k, c in columns.items() if c in fusion["pairs"].columns})
    return {"data": data, "features": features, "models": models, "explanation": explanation, "interests": interests,
            "fusion": fusion, "campaign": campaign}
