"""A/B evaluation of a targeted campaign on recorded conversions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.columns import clip, cut_fixed, ratio_or_null
from ..functions.draws import hash_cutoffs, hash_order
from ..functions.groups import join_groups
from ..functions.ordering import exact_quantiles, percent_rank_avg, right_closed_bin

CONTROL, TREATMENT = "control", "treatment"


def experiment_units(
    predictions: DataFrame, user: str = "user_id", label: str = "label", score: str = "score",
    item: str | None = None, category: str | None = None, price: str | None = None, first_by: Sequence[str] = (),
) -> DataFrame:
    """One unit per user, so that no user meets both treatments.

    ``first_by`` orders the rows whose item and category are kept; without it the smallest
    item and category are.
    """
    numbers = predictions.withColumns({
        label: F.col(label).try_cast("double"), score: F.col(score).try_cast("double")}).na.drop(subset=[label, score])
    measures = [F.max(label).cast("int").alias("label"), F.max(clip(F.col(score), 0, 1)).alias("score")]
    for name, column in (("item_id", item), ("item_category", category)):
        if column:
            known = F.when(F.col(column).isNotNull(), F.struct(*first_by, F.col(column).alias("_value")))
            measures.append(F.min(known)["_value"].alias(name))
    if price:
        measures.append(F.avg(price).alias("price"))
    return numbers.groupBy(F.col(user).alias("experiment_unit_id")).agg(*measures)


def target_population(units: DataFrame, top_ratio: float = K.TARGET_TOP_RATIO, score: str = "score", minimum: int = 20) -> DataFrame:
    """Units at or above the score quantile with the ``threshold``; the 20 best if there are fewer."""
    if not 0 < top_ratio <= 1:
        raise ValueError("top_ratio must lie in (0, 1]")
    limit = exact_quantiles(units, score, {"q": 1 - top_ratio}).scalar()
    targets = units.filter(F.col(score) >= limit)
    if targets.limit(minimum).count() < minimum:
        targets = units.orderBy(F.desc(score), "experiment_unit_id").limit(minimum)
        limit = targets.select(F.min(score)).scalar()
    return targets.withColumn("threshold", limit)


def score_edges(units: DataFrame, bins: int, score: str = "score") -> list[float]:
    """The ``bins + 1`` quantile edges of the score: a handful of numbers on the driver."""
    row = exact_quantiles(units, score, {f"e{i}": i / bins for i in range(bins + 1)}).first()
    return [] if row is None else [row[f"e{i}"] for i in range(bins + 1)]


def with_score_bins(units: DataFrame, bins: int, name: str, score: str = "score") -> DataFrame:
    """Adds the equal-frequency bin of the score."""
    edges = [F.lit(e) for e in score_edges(units, bins, score)]
    return units.withColumn(name, right_closed_bin(F.col(score), edges))


def stratified_assignment(targets: DataFrame, test_ratio: float = K.TEST_RATIO, score: str = "score", seed: int = K.SEED) -> DataFrame:
    """Adds ``score_stratum`` and ``ab_group``: the first half of each stratum in hash order is treated."""
    distinct = targets.select(score).distinct().limit(10).count()
    strata = with_score_bins(targets, min(10, max(2, distinct)), "score_stratum", score)
    n = F.col("n")
    wanted = F.least(F.greatest(F.bround(n * test_ratio), F.lit(1)), F.greatest(n - 1, F.lit(1)))
    quotas = strata.groupBy("score_stratum").agg(F.count("*").alias("n")).select(
        "score_stratum", wanted.cast("bigint").alias("quota"))
    cutoffs = hash_cutoffs(strata, ["experiment_unit_id"], quotas, ["score_stratum"], seed)
    joined = join_groups(strata, cutoffs.drop("quota"), ["score_stratum"])  # at most 10 strata and one of units without a score
    treated = hash_order(["experiment_unit_id"], seed) <= F.col("cutoff")
    return joined.select(*targets.columns, "score_stratum", F.when(treated, TREATMENT).otherwise(CONTROL).alias("ab_group"))


def baseline_rate(units: DataFrame) -> DataFrame:
    """Conversion of the control group, else of everyone, else 0.01."""
    control = F.avg(F.when(F.col("ab_group") == CONTROL, F.col("label")))
    positive = [F.when(rate > 0, rate) for rate in (control, F.avg("label"))]
    return units.agg(F.coalesce(*positive, F.lit(0.01)).alias("baseline_rate"))


def required_sample_size(rate: DataFrame, relative_lift: float = K.EXPECTED_RELATIVE_LIFT) -> DataFrame:
    """Units per group for a two-proportion test at 5 % significance and 80 % power."""
    base = clip(F.col("baseline_rate"), 0.001, 0.999)
    rates = rate.withColumns({"_c": base, "_t": clip(base * (1 + relative_lift), 0.001, 0.999)})
    c, t = F.col("_c"), F.col("_t")
    pooled = (c + t) / 2
    spread = F.lit(K.Z_ALPHA) * F.sqrt(2 * pooled * (1 - pooled)) + F.lit(K.Z_BETA) * F.sqrt(c * (1 - c) + t * (1 - t))
    size = F.coalesce(F.ceil(F.try_divide(spread * spread, (t - c) * (t - c))), F.lit(0)).cast("bigint")
    return rates.withColumn("required_sample_per_group", size).drop("_c", "_t")


def experiment_days(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Days until both groups are reached, between 14 and 28."""
    reached = F.greatest(F.floor(targets.select(F.count("*")).scalar() * F.lit(K.DAILY_REACH_RATE)), F.lit(1))
    days = F.ceil(F.col("required_sample_per_group") * 2 / reached)
    bounded = F.least(F.greatest(days, F.lit(K.MIN_EXPERIMENT_DAYS)), F.lit(K.MAX_EXPERIMENT_DAYS))
    return sizes.withColumn("experiment_days", bounded.cast("int"))


def group_metrics(units: DataFrame, price: str | None = None) -> DataFrame:
    """Size, conversions, revenue, costs and profit per group; conversions are the recorded labels."""
    value = F.lit(K.DEFAULT_ORDER_VALUE)
    if price:
        paid = units.filter(F.col(price).try_cast("double") > 0).withColumn("_paid", F.col(price).try_cast("double"))
        value = F.coalesce(exact_quantiles(paid, "_paid", {"q": 0.5}).scalar(), value)
    groups = units.groupBy(F.col("ab_group").alias("group")).agg(
        F.count("*").alias("sample_size"), F.sum("label").cast("bigint").alias("conversions"))
    cost = F.when(F.col("group") == TREATMENT, F.col("sample_size") * K.INCENTIVE_COST_PER_USER).otherwise(0.0)
    return groups.withColumns({
        "conversion_rate": ratio_or_null(F.col("conversions"), F.col("sample_size")),
        "average_order_value": value,
    }).withColumns({
        "revenue": F.col("conversions") * F.col("average_order_value"), "marketing_cost": cost,
    }).withColumn("variable_cost", F.col("revenue") * K.VARIABLE_COST_RATE).withColumn(
        "gross_profit", F.col("revenue") - F.col("variable_cost") - F.col("marketing_cost"))


@F.pandas_udf(T.DoubleType())
def _two_sided_p(z: pd.Series) -> pd.Series:
    """Spark has no error function; this runs on the one row of an experiment."""
    return z.map(lambda v: 2 * (1 - 0.5 * (1 + math.erf(abs(v) / math.sqrt(2)))) if pd.notna(v) else None)


def _side_by_side(metrics: DataFrame) -> DataFrame:
    """Two group rows as one row with prefixed columns."""
    names = [c for c in metrics.columns if c != "group"]
    return metrics.agg(*[
        F.max(F.when(F.col("group") == g, F.col(c))).alias(f"{p}_{c}") for g, p in ((TREATMENT, "t"), (CONTROL, "c")) for c in names])


def _z(row_t: Column, n_t: Column, row_c: Column, n_c: Column) -> Column:
    pooled = F.try_divide((row_t + row_c).cast("double"), n_t + n_c)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_t) + F.try_divide(F.lit(1.0), n_c)))
    gap = F.try_divide(row_t.cast("double"), n_t) - F.try_divide(row_c.cast("double"), n_c)
    return F.when(error == 0, 0.0).otherwise(F.try_divide(gap, error))


def two_proportion_z_test(metrics: DataFrame) -> DataFrame:
    """(z_value, p_value) of treatment against control."""
    both = _side_by_side(metrics.select("group", "conversions", "sample_size"))
    z = _z(*(F.col(c) for c in ("t_conversions", "t_sample_size", "c_conversions", "c_sample_size")))
    return both.select(z.alias("z_value")).withColumn("p_value", _two_sided_p("z_value"))


def effect_summary(metrics: DataFrame, sizes: DataFrame) -> DataFrame:
    """Lifts, significance, sample adequacy and return of the campaign, in one row.

    ``sizes`` has one row with ``required_sample_per_group`` and ``experiment_days``.
    """
    required = sizes.select("required_sample_per_group").scalar()
    days = sizes.select("experiment_days").scalar()
    both = _side_by_side(metrics)
    t_rate, c_rate = F.col("t_conversion_rate"), F.col("c_conversion_rate")
    n_t, n_c, cost = F.col("t_sample_size"), F.col("c_sample_size"), F.col("t_marketing_cost")
    z = _z(F.col("t_conversions"), n_t, F.col("c_conversions"), n_c)
    extra = F.col("t_conversions") - n_t * c_rate
    revenue = extra * F.col("t_average_order_value")
    profit = revenue * (1 - K.VARIABLE_COST_RATE) - cost
    return both.select(
        c_rate.alias("control_conversion_rate"), t_rate.alias("treatment_conversion_rate"),
        (t_rate - c_rate).alias("absolute_lift"), ratio_or_null(t_rate - c_rate, c_rate).alias("relative_lift"),
        z.alias("z_value"), required.alias("required_sample_per_group"),
        n_t.alias("actual_treatment_sample"), n_c.alias("actual_control_sample"),
        ((n_t >= required) & (n_c >= required)).alias("sample_size_sufficient"),
        days.alias("recommended_experiment_days"), extra.alias("incremental_conversions"),
        revenue.alias("incremental_revenue"), profit.alias("incremental_profit"),
        ratio_or_null(profit, cost).alias("marketing_roi"),
    ).withColumn("p_value", _two_sided_p("z_value")).withColumn(
        "statistically_significant", F.col("p_value") < K.ALPHA)


def score_segment_analysis(units: DataFrame, score: str = "score") -> DataFrame:
    """Score and conversion per quintile and group; one segment for all if quintiles collapse."""
    edges = score_edges(units, len(K.SCORE_SEGMENTS), score)
    if len(set(edges)) == len(K.SCORE_SEGMENTS) + 1:
        labels = F.array(*[F.lit(s) for s in K.SCORE_SEGMENTS])
        segment = F.get(labels, right_closed_bin(F.col(score), [F.lit(e) for e in edges]).cast("int"))
    else:
        segment = F.lit(K.SEGMENT_EVERYONE)
    named = units.withColumn("score_segment", segment)
    return named.groupBy("score_segment", F.col("ab_group").alias("group")).agg(
        F.count("*").alias("sample_size"), F.avg(score).alias("average_model_score"), F.avg("label").alias("conversion_rate"))


def category_recommendations(units: DataFrame, score: str = "score", category: str = "item_category") -> DataFrame:
    """Categories by a mix of score, conversion and size percentiles."""
    table = units.groupBy(F.col(category).alias("category")).agg(
        F.count("experiment_unit_id").alias("target_users"), F.avg(score).alias("average_model_score"),
        F.avg("label").alias("conversion_rate"))
    ranked = percent_rank_avg(
        table, {"average_model_score": "_s", "conversion_rate": "_c", "target_users": "_u"}, "category")
    priority = F.col("_s") * 0.5 + F.col("_c") * 0.3 + F.col("_u") * 0.2
    level = cut_fixed(F.col("priority_score"), (0.40, 0.70), (K.PRIORITY_LOW, K.PRIORITY_MID, K.PRIORITY_HIGH))
    scored = ranked.withColumn("priority_score", priority).withColumn("recommendation_priority", level)
    return scored.drop("_s", "_c", "_u").orderBy(F.desc("priority_score"), F.desc("target_users"), "category")
