"""Activity, popularity, funnel and repurchase reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import activity_group, week_label_period, week_label_yw
from .joins import fact_dim_join
from .marts import count_behavior


def total_behavior_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("total_behavior_count"))


def behavior_count(fact: DataFrame) -> DataFrame:
    return fact.groupBy("behavior_type").agg(F.count("*").alias("behavior_count"))


def behavior_ratio(fact: DataFrame) -> DataFrame:
    total = fact.select(F.count("*")).scalar()
    return behavior_count(fact).withColumn("ratio", F.round(F.col("behavior_count") / total, 4))


def daily_active_users(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.to_date("time").alias("date")).agg(
        F.count_distinct("user_id").alias("daily_active_users")).orderBy("date")


def weekly_active_users(fact: DataFrame) -> DataFrame:
    return _weekly(fact, ["_monday", "_year"], week_label_yw)


def weekly_active_users_period(events: DataFrame) -> DataFrame:
    return _weekly(events, ["_monday"], week_label_period)


def _weekly(events: DataFrame, week: list[str], label) -> DataFrame:
    """Users of each week. Weeks are dates until they are counted, so labels are made once a week and not once an event."""
    day = F.to_date("time")
    placed = events.select("user_id", day.alias("_day"), F.date_sub(day, F.weekday(day)).alias("_monday"), F.year(day).alias("_year"))
    users = placed.groupBy(*week).agg(F.count_distinct("user_id").alias("weekly_active_users"), F.min("_day").alias("_day"))
    return users.select(label(F.col("_day")).alias("week"), "weekly_active_users").orderBy("week")


def hot_items(fact: DataFrame, n: int = 10) -> DataFrame:
    counts = fact.groupBy("item_id").agg(F.count("*").alias("behavior_count"))
    return counts.orderBy(F.desc("behavior_count"), "item_id").limit(n)


def hot_categories(fact: DataFrame, dim_item: DataFrame, n: int = 10) -> DataFrame:
    return fact_dim_join(fact, dim_item).orderBy(F.desc("behavior_count"), "item_category").limit(n)


def top_categories(events: DataFrame, n: int = 20) -> DataFrame:
    counts = events.groupBy("item_category").agg(F.count("*").alias("behavior_count"))
    return counts.orderBy(F.desc("behavior_count"), "item_category").limit(n)


def behavior_sequence(fact: DataFrame, n: int = 100) -> DataFrame:
    """First rows in (user, time) order; each task keeps only ``n`` rows."""
    rows = fact.select("user_id", "item_id", "behavior_type", "time")
    return rows.orderBy("user_id", "time", "item_id", "behavior_type").limit(n)


def funnel_users(fact: DataFrame) -> DataFrame:
    return fact.groupBy("behavior_type").agg(F.count_distinct("user_id").alias("user_count")).orderBy(
        F.desc("user_count"), "behavior_type")


def user_group(fact: DataFrame) -> DataFrame:
    per_user = fact.groupBy("user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy(activity_group(F.col("n")).alias("user_group")).agg(F.count("*").alias("user_count"))


def item_buyers(fact: DataFrame) -> DataFrame:
    """Buyers and repeat buyers per item, from one count per (user, item)."""
    pairs = fact.filter(F.col("behavior_type") == K.BUY).groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    return pairs.groupBy("item_id").agg(
        F.count("*").alias("total_buyers"), F.count_if(F.col("n") > 1).alias("repeat_buyers"))


def repurchase_rate_top(fact: DataFrame, n: int = 10) -> DataFrame:
    rate = F.round(F.col("repeat_buyers") / F.col("total_buyers"), 4)
    return item_buyers(fact).withColumn("repurchase_rate", rate).orderBy(
        F.desc("repurchase_rate"), "item_id").limit(n)


def repurchase_left_join(fact: DataFrame) -> DataFrame:
    """Rate of every bought item. The two counts come from one aggregate, so nothing is joined."""
    rate = F.round(F.coalesce(F.col("repeat_buyers"), F.lit(0)) / F.col("total_buyers"), 4)
    return item_buyers(fact).withColumn("repurchase_rate", rate)


def pivot_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Counts per behaviour code, 0 where a code is missing."""
    return events.groupBy(key).agg(
        count_behavior(K.BROWSE).alias("pv_count"), count_behavior(K.FAVOURITE).alias("fav_count"),
        count_behavior(K.CART).alias("cart_count"), count_behavior(K.BUY).alias("buy_count"))
