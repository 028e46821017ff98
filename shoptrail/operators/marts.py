"""The five marts and the star schema.

Counts are summed map-side, so a hot key sends one partial row per task. Distinct counts
shuffle on (key, value) first, which spreads a hot key over its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import ratio_or_null, with_time_parts


def count_behavior(code: int) -> Column:
    return F.count_if(F.col("behavior_type") == code)


def behavior_counts(*names: str) -> list[Column]:
    """One count per behaviour code 1..4 under the given names."""
    return [count_behavior(code).alias(name) for code, name in zip(K.BEHAVIOURS, names)]


def user_table(events: DataFrame) -> DataFrame:
    dated = events.withColumn("date", F.to_date("time"))
    table = dated.groupBy("user_id").agg(
        F.count("behavior_type").alias("action_count"),
        *behavior_counts("browse_count", "fav_count", "cart_count", "buy_count"),
        F.count_distinct("date").alias("active_days"),
        F.min("time").alias("first_active_time"),
        F.max("time").alias("last_active_time"),
        F.count_distinct("item_id").alias("unique_item_count"),
        F.count_distinct("item_category").alias("unique_category_count"),
    )
    return table.withColumn("conversion_rate", ratio_or_null(F.col("buy_count"), F.col("action_count")))


def item_table(events: DataFrame) -> DataFrame:
    """``buyer_count`` counts all users who touched the item; the category is the earliest one."""
    dated = events.withColumn("date", F.to_date("time"))
    table = dated.groupBy("item_id").agg(
        F.count("behavior_type").alias("item_action_count"),
        *behavior_counts("item_browse_count", "item_fav_count", "item_cart_count", "item_buy_count"),
        F.count_distinct("user_id").alias("buyer_count"),
        F.count_distinct("date").alias("item_active_days"),
    ).join(item_categories(events), "item_id", "left")
    return table.withColumn("item_conversion_rate", ratio_or_null(F.col("item_buy_count"), F.col("item_action_count")))


def item_categories(events: DataFrame) -> DataFrame:
    """(item_id, item_category): the earliest category of each item.

    The first aggregate is a hash aggregate over all events; only its few rows per item meet
    the struct minimum, which sorts.
    """
    pairs = events.groupBy("item_id", "item_category").agg(F.min("time").alias("time"))
    return pairs.groupBy("item_id").agg(first_category().alias("item_category"))


def first_category() -> Column:
    """Category of the earliest row that has one; equal times fall to the smaller category."""
    known = F.when(F.col("item_category").isNotNull(), F.struct("time", "item_category"))
    return F.min(known)["item_category"]


def time_table(events: DataFrame) -> DataFrame:
    table = events.groupBy(F.to_date("time").alias("date")).agg(
        F.count("behavior_type").alias("daily_action_count"),
        *behavior_counts("daily_browse_count", "daily_fav_count", "daily_cart_count", "daily_buy_count"),
        F.count_distinct("user_id").alias("active_user_count"),
        F.count_distinct("item_id").alias("active_item_count"),
    )
    return table.withColumn("daily_conversion_rate", ratio_or_null(F.col("daily_buy_count"), F.col("daily_action_count")))


def category_table(events: DataFrame) -> DataFrame:
    """The rate is buys per browse and NULL for a category without a browse."""
    table = events.groupBy("item_category").agg(
        *behavior_counts("pv_count", "fav_count", "cart_count", "buy_count"),
        F.count_distinct("item_id").alias("item_count"),
        F.count_distinct("user_id").alias("user_count"),
    )
    return table.withColumn("conversion_rate", ratio_or_null(F.col("buy_count"), F.col("pv_count")))


def user_item_table(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id", "item_id").agg(
        *behavior_counts("ui_pv_count", "ui_fav_count", "ui_cart_count", "ui_buy_count"),
        F.max("time").alias("last_behavior_time"),
    )


def star_schema(events: DataFrame) -> dict[str, DataFrame]:
    parts = with_time_parts(events)
    return {
        "dim_user": events.select("user_id").distinct(),
        "dim_item": events.select("item_id", "item_category").distinct(),
        "dim_time": parts.select("time", "date", "hour", "weekday", "month").distinct(),
        "fact_user_behavior": events.select("time", "user_id", "item_id", "behavior_type"),
    }
