"""When users are active, and life cycles of users and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import active_level, is_night, last_day, ratio_or_null, time_period
from .joins import left_join_category
from .marts import first_category

_PERIODS = (K.NIGHT, K.MORNING, K.AFTERNOON, K.EVENING)


def hour_counts(events: DataFrame) -> DataFrame:
    """Events per (user, hour): at most 24 rows per user, and the base of all time features."""
    timed = events.filter(F.col("time").isNotNull())
    return timed.groupBy("user_id", F.hour("time").alias("hour")).agg(F.count("*").alias("n"))


def _peak_hour():
    """Largest count, smallest hour, packed in one number: a struct maximum would sort every task's rows."""
    return F.max(F.col("n") * 32 + (31 - F.col("hour")))


def _unpacked(peak):
    """(count, hour) of a packed peak."""
    return F.shiftright(peak, 5), (31 - peak.bitwiseAND(F.lit(31))).cast("int")


def peak_hour(events: DataFrame) -> DataFrame:
    """Most active hour per user; the smaller hour wins a tie."""
    peak = hour_counts(events).groupBy("user_id").agg(_peak_hour().alias("p"), F.sum("n").alias("t"))
    count, hour = _unpacked(F.col("p"))
    return peak.select(
        "user_id", hour.alias("peak_active_hour"), count.alias("peak_hour_behavior_count"),
        ratio_or_null(count, F.col("t")).alias("peak_hour_behavior_ratio"))


def _period_sums():
    return [F.coalesce(F.sum(F.when(time_period(F.col("hour")) == p, F.col("n"))), F.lit(0)).alias(f"_{i}")
            for i, p in enumerate(_PERIODS)]


def _best_period():
    """Period with the most events; the smaller label wins a tie."""
    place = {p: -i for i, p in enumerate(sorted(_PERIODS))}
    return F.array_max(F.array(*[
        F.struct(F.col(f"_{i}").alias("n"), F.lit(place[p]).alias("o"), F.lit(p).alias("period"))
        for i, p in enumerate(_PERIODS)]))


def peak_period(events: DataFrame) -> DataFrame:
    sums = hour_counts(events).groupBy("user_id").agg(*_period_sums(), F.sum("n").alias("t"))
    best = sums.withColumn("p", _best_period())
    return best.select(
        "user_id", F.col("p.period").alias("peak_active_period"), F.col("p.n").alias("peak_period_behavior_count"),
        ratio_or_null(F.col("p.n"), F.col("t")).alias("peak_period_behavior_ratio"))


def time_features(events: DataFrame) -> DataFrame:
    """Totals, peak hour, peak period and night share per user: one scan, no joins."""
    n = F.col("n")
    per_user = hour_counts(events).groupBy("user_id").agg(
        F.sum("n").alias("t"), _peak_hour().alias("ph"), *_period_sums(),
        F.sum(is_night(F.col("hour")) * n).alias("night"),
    ).withColumn("pp", _best_period())
    total = F.col("t")
    count, hour = _unpacked(F.col("ph"))
    return per_user.select(
        "user_id", total.alias("total_behavior_count"),
        hour.alias("peak_active_hour"), count.alias("peak_hour_behavior_count"),
        ratio_or_null(count, total).alias("peak_hour_behavior_ratio"),
        F.col("pp.period").alias("peak_active_period"),
        F.col("pp.n").alias("peak_period_behavior_count"),
        ratio_or_null(F.col("pp.n"), total).alias("peak_period_behavior_ratio"),
        F.col("night").alias("night_behavior_count"),
        ratio_or_null(F.col("night"), total).alias("night_behavior_ratio"),
    )


def _daily(events: DataFrame) -> DataFrame:
    dated = events.filter(F.col("time").isNotNull())
    return dated.groupBy("user_id", F.to_date("time").alias("date")).agg(F.count("*").alias("n"))


def _with_streak(daily: DataFrame) -> DataFrame:
    """Days of one streak share (date - position). A user has one row per active day here."""
    position = F.row_number().over(Window.partitionBy("user_id").orderBy("date"))
    return daily.withColumn("streak", F.date_sub("date", position))


def max_active_streak(events: DataFrame) -> DataFrame:
    """Longest run of consecutive active days per user."""
    runs = _with_streak(_daily(events)).groupBy("user_id", "streak").agg(F.count("*").alias("days"))
    return runs.groupBy("user_id").agg(F.max("days").alias("max_continuous_active_days"))


def user_lifecycle_features(events: DataFrame, recent_days: int = 30) -> DataFrame:
    """Counts, recency and streaks per user, all derived from one row per (user, day).

    The two aggregates after the window keep its partitioning, so they do not shuffle.
    """
    newest = last_day(events)
    recent = F.col("date") >= F.date_sub(newest, recent_days)
    runs = _with_streak(_daily(events)).groupBy("user_id", "streak").agg(
        F.count("*").alias("days"), F.sum("n").alias("n"),
        F.sum(F.when(recent, F.col("n"))).alias("recent"), F.max("date").alias("last"))
    per_user = runs.groupBy("user_id").agg(
        F.sum("n").alias("total_behavior_count"), F.sum("days").alias("active_days"),
        F.sum("recent").alias("recent_30_behavior_count"), F.max("last").alias("last_active_date"),
        F.max("days").alias("max_continuous_active_days"))
    return per_user.select(
        "user_id", "total_behavior_count", "active_days", "recent_30_behavior_count",
        active_level(F.col("recent_30_behavior_count")).alias("short_term_active_level"),
        "last_active_date", F.date_diff(newest, "last_active_date").alias("churn_gap_days"),
        "max_continuous_active_days")


def item_lifecycle_features(events: DataFrame, recent_days: int = 7) -> DataFrame:
    """Totals, recent heat and category competition per item."""
    timed = events.filter(F.col("time").isNotNull())
    recent = F.to_date("time") >= F.date_sub(last_day(timed), recent_days)
    pairs = timed.groupBy("item_id", "item_category").agg(
        F.count("*").alias("n"), F.count_if(recent).alias("recent"), F.min("time").alias("time"))
    items = pairs.groupBy("item_id").agg(
        F.sum("n").alias("item_total_behavior_count"), F.sum("recent").alias("item_recent_7_behavior_count"),
        first_category().alias("item_category"))
    items = items.withColumn("heat_decay_score", ratio_or_null(
        F.col("item_recent_7_behavior_count"), F.col("item_total_behavior_count")))
    sizes = items.groupBy("item_category").agg(F.count("*").alias("category_item_count"))
    joined = left_join_category(items, sizes)
    return joined.withColumn("category_competition_degree", F.col("category_item_count"))
