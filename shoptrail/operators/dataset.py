"""Labels, history filter, balancing, encoding, scaling, splits and feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import last_day, ratio_or_null, start_of
from ..functions.groups import join_groups
from ..functions.draws import hash_cutoffs, hash_order, sample_exact, take_by_hash
from ..session import materialize
from . import forest
from .cleaning import replace_inf
from .joins import flag_users, lookup_join, semi_join_users
from .oversampling import smote_oversample  # noqa: F401

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _label_start(events: DataFrame, label_days: int) -> Column:
    """First moment of the label window: the day after ``last day - label_days``."""
    return start_of(F.date_sub(last_day(events), label_days - 1))


def label_buyers(events: DataFrame, label_days: int = 7) -> DataFrame:
    bought = (F.col("time") >= _label_start(events, label_days)) & (F.col("behavior_type") == K.BUY)
    return events.filter(bought).select("user_id").distinct()


def purchase_label(features: DataFrame, events: DataFrame, label_days: int = 7) -> DataFrame:
    """Label 1 for users who buy in the last ``label_days`` days."""
    return flag_users(features, label_buyers(events, label_days), "label")


def history_users(events: DataFrame, label_days: int = 7) -> DataFrame:
    return events.filter(F.col("time") < _label_start(events, label_days)).select("user_id").distinct()


def history_filter(features: DataFrame, events: DataFrame, label_days: int = 7) -> DataFrame:
    """Users with at least one event before the label window."""
    return semi_join_users(features, history_users(events, label_days))


def undersample_balanced(dataset: DataFrame, keys: Sequence[str] = ("user_id",), seed: int = K.SEED) -> DataFrame:
    """As many rows of each label as the smaller label has, drawn by key hash; rows without a label are left out."""
    counts = dataset.filter(F.col("label").isin(0, 1)).groupBy("label").agg(F.count("*").alias("n"))
    present = {r["label"] for r in counts.collect()}  # two rows
    if not {0, 1} <= present:
        raise ValueError("both labels are needed to balance a dataset")
    smaller = counts.select(F.min("n")).scalar()
    return take_by_hash(dataset, keys, counts.select("label", smaller.alias("quota")), ["label"], seed)


def target_encode(dataset: DataFrame, columns: Sequence[str], label: str = "label", fit_on: DataFrame | None = None) -> DataFrame:
    """Adds ``<c>_target_encoded``, the mean label per level; NULL is a level of its own.

    ``fit_on`` takes the means from other rows (the training split) instead of all rows.
    """
    source = dataset if fit_on is None else fit_on
    for c in columns:
        means = source.groupBy(c).agg(F.avg(label).alias(f"{c}_target_encoded"))
        dataset = lookup_join(dataset, means, c)
    return dataset


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("user_id", "label")) -> list[str]:
    return [c for c, t in df.dtypes if t in _NUMERIC and c not in exclude]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def standardize(dataset: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0, bad numbers count as 0.

    All means and deviations come from one aggregate, read as a scalar subquery.
    """
    clean = replace_inf(dataset, columns)
    source = clean if fit_on is None else replace_inf(fit_on, columns)
    moments = source.agg(F.struct(*[
        m for c in columns for m in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).alias("moments"))
    known = clean.withColumn("_moments", moments.scalar())  # read once, then plain struct fields
    return known.withColumns({
        c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_moments.m_{c}"), F.col(f"_moments.s_{c}")), F.lit(0.0))
        for c in columns}).drop("_moments")


def stratified_split(
    dataset: DataFrame, keys: Sequence[str] = ("user_id",), label: str = "label",
    percents: tuple[int, int] = (70, 20), seed: int = K.SEED,
) -> DataFrame:
    """Adds ``split``: per label the first 70 % in hash order train, the next 20 % validate, the rest test."""
    counts = dataset.groupBy(label).agg(F.count("*").alias("n"))  # one row per label, NULL is one
    ends = F.explode(F.array(*[F.struct(F.lit(n).alias("end"), F.lit(p).alias("percent")) for n, p in (("train", percents[0]), ("valid", sum(percents)))]))
    quotas = materialize(counts.select(label, "n", ends.alias("_e")).select(
        label, F.col("_e.end").alias("_end"), F.floor(F.col("n") * F.col("_e.percent") / 100).cast("bigint").alias("quota")))
    cutoffs = hash_cutoffs(dataset, keys, quotas, [label], seed, ["_end"])
    of = lambda end: F.max(F.when(F.col("_end") == end, F.col("cutoff")))
    cuts = materialize(cutoffs.groupBy(label).agg(of("train").alias("_train"), of("valid").alias("_valid")))
    digest = hash_order(keys, seed)
    joined = join_groups(dataset, cuts, [label])
    split = F.when(digest <= F.col("_train"), "train").when(digest <= F.col("_valid"), "valid").otherwise("test")
    return joined.select(*dataset.columns, split.alias("split"))


def class_weights(dataset: DataFrame, label: str = "label") -> DataFrame:
    """(class, class_weight) with weight n / (classes * n_class); NULL is no class."""
    counts = dataset.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    classes = counts.select(F.count("*")).scalar()
    return counts.select("class", ratio_or_null(total, classes * F.col("n")).alias("class_weight"))


def scale_pos_weight(dataset: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive."""
    negative, positive = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return dataset.agg(ratio_or_null(negative, positive).alias("scale_pos_weight"))


def label_correlation(dataset: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, correlation): absolute Pearson correlation with the label, NULL for constants, strongest first."""
    def strength(c):
        x, y = F.col(c).cast("double"), F.col(label).cast("double")
        return F.abs(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))

    row = dataset.agg(*[strength(c).alias(c) for c in columns])
    return row.unpivot([], list(columns), "feature", "correlation").orderBy(F.desc_nulls_last("correlation"), "feature")


def feature_importance_rf(
    dataset: DataFrame, columns: Sequence[str], label: str = "label",
    trees: int = 100, depth: int = 30, seed: int = K.SEED,
) -> DataFrame:
    """(feature, importance) of a random forest, highest first; trees grow to 30 levels. See ``forest``."""
    importances = forest.importances(dataset, columns, label, trees, depth, seed)
    rows = sorted(zip(columns, importances), key=lambda r: (-r[1], r[0]))
    return dataset.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, n: int = 30) -> list[str]:
    return [r["feature"] for r in importance.orderBy(F.desc("importance"), "feature").limit(n).collect()]


def select_top_features(
    dataset: DataFrame, importance: DataFrame, n: int = 30, keep: Sequence[str] = ("user_id", "label"),
) -> DataFrame:
    return dataset.select(*keep, *top_features(importance, n))


def dataset_summary(stages: dict[str, DataFrame], events: DataFrame, label_days: int = 7) -> DataFrame:
    """One row: rows per stage, feature end date and label end date."""
    newest = last_day(events)
    return events.sparkSession.range(1).select(
        *[df.select(F.count("*")).scalar().alias(f"{name}_rows") for name, df in stages.items()],
        F.date_sub(newest, label_days).alias("feature_end_date"), newest.alias("label_end_date"))
