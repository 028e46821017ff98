"""Recency, frequency and value scores, personal funnel rates, preference score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import safe_ratio, weight_of
from ..functions.ordering import global_rank, qcut_codes
from ..session import materialize
from .activity import pivot_counts
from .marts import behavior_counts

BINS = 5


def _user_measures(events: DataFrame) -> DataFrame:
    """Every per-user number the business features need, from one aggregate."""
    weight = weight_of(F.col("behavior_type"), K.VALUE_WEIGHTS)
    return events.groupBy("user_id").agg(
        F.max("time").alias("_last"),
        *behavior_counts("pv_count", "fav_count", "cart_count", "buy_count"),
        F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias("behavior_value_score"))


def _rfm(events: DataFrame) -> DataFrame:
    """Per-user measures with recency, frequency and the three scores.

    The measures are written once, since ranks, last day and scores read them: events are aggregated a single time. The three ranks ("first" ties go to the smaller user id) come from one range shuffle of a
    long table with three rows per user. R runs from 2 to 6, F and M from 1 to 5.
    """
    measures = materialize(_user_measures(events))
    newest = F.to_date(measures.select(F.max("_last")).scalar())
    day = F.to_date("_last")
    base = measures.withColumns({
        "last_behavior_date": day,
        "recency_days": F.date_diff(newest, day),
        "buy_frequency": F.col("buy_count"),
    })
    long = base.select("user_id", F.explode(F.create_map(
        F.lit("R"), F.col("recency_days").cast("bigint"),
        F.lit("F"), F.col("buy_frequency"),
        F.lit("M"), F.col("behavior_value_score"))).alias("_measure", "_value"))
    ranked = global_rank(long, ["_value", "user_id"], ["_measure"], "_rank")
    users = ranked.filter(F.col("_measure") == "R").select(F.count("*")).scalar()
    code = qcut_codes(F.col("_rank"), users, BINS)
    codes = ranked.withColumn("_code", code).groupBy("user_id").agg(*[
        F.max(F.when(F.col("_measure") == m, F.col("_code"))).alias(f"_{m}") for m in "RFM"])
    scored = base.join(codes, "user_id").withColumns({
        "R_score": 6 - F.col("_R"), "F_score": F.col("_F") + 1, "M_score": F.col("_M") + 1})
    return scored.withColumn("rfm_value_score", F.col("R_score") + F.col("F_score") + F.col("M_score"))


_RFM_COLUMNS = (
    "user_id", "last_behavior_date", "recency_days", "buy_frequency", "behavior_value_score",
    "R_score", "F_score", "M_score", "rfm_value_score",
)


def rfm_features(events: DataFrame) -> DataFrame:
    return _rfm(events).select(*_RFM_COLUMNS)


def _funnel_rates() -> dict:
    return {
        "fav_to_pv_rate": safe_ratio(F.col("fav_count"), F.col("pv_count")),
        "cart_to_fav_rate": safe_ratio(F.col("cart_count"), F.col("fav_count")),
        "buy_to_cart_rate": safe_ratio(F.col("buy_count"), F.col("cart_count")),
        "buy_to_pv_rate": safe_ratio(F.col("buy_count"), F.col("pv_count")),
    }


def user_funnel(events: DataFrame) -> DataFrame:
    return pivot_counts(events).withColumns(_funnel_rates())


def user_preference_score(events: DataFrame) -> DataFrame:
    return _user_measures(events).select("user_id", F.col("behavior_value_score").alias("user_preference_score"))


def business_features(events: DataFrame) -> DataFrame:
    """Scores, funnel and preference per user. No joins between the parts: they share one aggregate."""
    scored = _rfm(events).withColumns(_funnel_rates())
    return scored.select(
        *_RFM_COLUMNS, "pv_count", "fav_count", "cart_count", "buy_count", *_funnel_rates(),
        F.col("behavior_value_score").alias("user_preference_score"))
