"""Exploratory reports: hours, funnel, buyer segments, categories, repurchase, day types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import day_type, ratio_or_null, safe_ratio
from ..functions.ordering import global_rank, qcut_codes
from .marts import behavior_counts, count_behavior


def hour_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("time").alias("hour")).agg(F.count("*").alias("behavior_count")).orderBy("hour")


def _view_buy(events: DataFrame, key: Column, name: str, view: str, buy: str) -> DataFrame:
    """View and buy counts per key, keys with neither left out, and their ratio."""
    seen = events.filter(F.col("behavior_type").isin(K.BROWSE, K.BUY) & key.isNotNull())
    counts = seen.groupBy(key.alias(name)).agg(count_behavior(K.BROWSE).alias(view), count_behavior(K.BUY).alias(buy))
    return counts.withColumn("conversion_rate", safe_ratio(F.col(buy), F.col(view)))


def hour_conversion_rate(events: DataFrame) -> DataFrame:
    return _view_buy(events, F.hour("time"), "hour", "view", "buy").orderBy("hour")


def category_conversion_rate(events: DataFrame) -> DataFrame:
    rates = _view_buy(events, F.col("item_category"), "item_category", "view_count", "buy_count")
    return rates.orderBy(F.desc("conversion_rate"), "item_category")


def _funnel_counts(events: DataFrame) -> DataFrame:
    """One row with the distinct users of each behaviour.

    Behaviours are first reduced to one flag set per user; the last step adds numbers only.
    """
    flags = events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*[
        F.max(F.when(F.col("behavior_type") == code, 1)).alias(name)
        for code, name in zip(K.BEHAVIOURS, ("view", "favorite", "cart", "buy"))
    ])
    return flags.agg(*[F.count(c).alias(c) for c in ("view", "favorite", "cart", "buy")])


def conversion_funnel(events: DataFrame) -> DataFrame:
    """(stage, users, step_rate): the rate compares a stage with the one before it."""
    return _funnel_counts(events).select(F.inline(F.array(
        _stage("View", "view", F.lit(None).cast("double")),
        _stage("Favorite", "favorite", safe_ratio(F.col("favorite"), F.col("view"))),
        _stage("Cart", "cart", safe_ratio(F.col("cart"), F.col("favorite"))),
        _stage("Buy", "buy", safe_ratio(F.col("buy"), F.col("cart"))),
    )))


def _stage(label: str, column: str, rate: Column) -> Column:
    return F.struct(F.lit(label).alias("stage"), F.col(column).alias("users"), rate.alias("step_rate"))


def drop_rate(events: DataFrame) -> DataFrame:
    """(step, drop_rate, is_largest) of the three funnel steps; the first largest step is marked."""
    steps = (("View -> Favorite", "favorite", "view"), ("Favorite -> Cart", "cart", "favorite"), ("Cart -> Buy", "buy", "cart"))
    lost = [1 - safe_ratio(F.col(after), F.col(before)) for _, after, before in steps]
    worst = F.array_max(F.array(*[F.struct(x.alias("lost"), F.lit(-i).alias("place")) for i, x in enumerate(lost)]))
    return _funnel_counts(events).select(F.inline(F.array(*[
        F.struct(F.lit(title).alias("step"), x.alias("drop_rate"), (worst["place"] == -i).alias("is_largest"))
        for i, ((title, _, _), x) in enumerate(zip(steps, lost))])))


def rfm_buyers(events: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value (= frequency) of every buyer."""
    buys = events.filter(F.col("behavior_type") == K.BUY)
    snapshot = F.to_date(buys.select(F.max("time")).scalar())
    per_user = buys.groupBy("user_id").agg(F.max("time").alias("_last"), F.count("*").alias("frequency"))
    return per_user.select(
        "user_id", F.date_diff(snapshot, F.to_date("_last")).alias("recency"),
        "frequency", F.col("frequency").alias("monetary"))


def rfm_segment(events: DataFrame) -> DataFrame:
    """Quartile scores 1..4 and the value segment of every buyer.

    The rank of recency and of frequency comes from one range shuffle over both measures.
    """
    long = rfm_buyers(events).select(
        "user_id", F.explode(F.create_map(
            F.lit("r"), F.col("recency").cast("bigint"), F.lit("f"), F.col("frequency"))).alias("_measure", "_value"))
    ranked = global_rank(long, ["_value", "user_id"], ["_measure"], "_rank")
    wide = ranked.groupBy("user_id").agg(*[
        F.max(F.when(F.col("_measure") == m, F.col(c))).alias(f"_{m}{c}") for m in "rf" for c in ("_rank", "_value")])
    buyers = ranked.filter(F.col("_measure") == "r").select(F.count("*")).scalar()
    # with fewer than 4 buyers there are as many bins as buyers
    quarter = F.when(buyers >= 4, qcut_codes(F.col("_r_rank"), buyers, 4)).otherwise(F.col("_r_rank") - 1)
    quarter_f = F.when(buyers >= 4, qcut_codes(F.col("_f_rank"), buyers, 4)).otherwise(F.col("_f_rank") - 1)
    top = F.least(buyers, F.lit(4))
    scored = wide.select(
        "user_id", F.col("_r_value").cast("int").alias("recency"), F.col("_f_value").alias("frequency"),
        (top - quarter).cast("bigint").alias("r_score"), (quarter_f + 1).cast("bigint").alias("f_score"))
    scored = scored.withColumn("m_score", F.col("f_score"))  # monetary equals frequency
    r, f = F.col("r_score") >= 3, F.col("f_score") >= 3
    segment = (F.when(r & f, K.SEGMENT_HIGH).when(r, K.SEGMENT_POTENTIAL)
               .when(f, K.SEGMENT_RISK).otherwise(K.SEGMENT_DORMANT))
    return scored.withColumn("segment", segment)


def segment_count(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("user_count"))


def segment_inner_join(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Counts per user and behaviour of segmented users. Events are counted before the join."""
    per_user = events.groupBy("user_id").agg(
        *behavior_counts("view_count", "favorite_count", "cart_count", "buy_count"))
    return per_user.join(segments.select("user_id", "segment"), "user_id")


def segment_behavior(events: DataFrame, segments: DataFrame) -> DataFrame:
    names = ("view_count", "favorite_count", "cart_count", "buy_count")
    totals = segment_inner_join(events, segments).groupBy("segment").agg(*[F.sum(c).alias(c) for c in names])
    return totals.withColumn("conversion_rate", safe_ratio(F.col("buy_count"), F.col("view_count")))


def repurchase_overall(events: DataFrame) -> DataFrame:
    """Share of (user, item) purchase pairs bought more than once."""
    pairs = events.filter(F.col("behavior_type") == K.BUY).groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    counts = pairs.agg(F.count("*").alias("pair_count"), F.count_if(F.col("n") > 1).alias("repeat_pair_count"))
    return counts.withColumn("repurchase_rate", safe_ratio(F.col("repeat_pair_count"), F.col("pair_count")))


def top_repurchased_items(events: DataFrame, n: int = 20) -> DataFrame:
    pairs = events.filter(F.col("behavior_type") == K.BUY).groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    items = pairs.filter(F.col("n") > 1).groupBy("item_id").agg(F.count("*").alias("repeat_users"))
    return items.orderBy(F.desc("repeat_users"), "item_id").limit(n)


def day_type_behavior(events: DataFrame) -> DataFrame:
    counts = events.groupBy(day_type(F.col("time")).alias("day_type")).agg(
        *behavior_counts("view", "favorite", "cart", "buy"))
    return counts.withColumn("conversion_rate", safe_ratio(F.col("buy"), F.col("view")))


def eda_summary(events: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    base = events.agg(
        F.count("*").alias("row_count"), F.count_distinct("user_id").alias("user_count"),
        F.count_distinct("item_id").alias("item_count"), F.count_distinct("item_category").alias("category_count"),
        F.to_date(F.min("time")).alias("first_date"), F.to_date(F.max("time")).alias("last_date"))
    stages = _funnel_counts(events)
    view_to_buy = stages.select(safe_ratio(F.col("buy"), F.col("view"))).scalar()
    worst = drop_rate(events).filter("is_largest").select("step").scalar()
    return base.withColumns({
        **{f"{c}_users": stages.select(c).scalar() for c in ("view", "favorite", "cart", "buy")},
        "view_to_buy_rate": view_to_buy,
        "repurchase_rate": repurchase_overall(events).select("repurchase_rate").scalar(),
        "largest_drop": worst,
    })


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    total = df.select(F.count("*")).scalar()
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", ratio_or_null(F.col("n"), total))
