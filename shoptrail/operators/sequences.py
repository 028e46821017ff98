"""Order of events within a user: previous event, transitions, last-n sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio_or_null, seconds_between
from ..session import materialize
from .joins import HOT_ROWS, hot_keys, with_keys

EVENT_ORDER = ("time", "item_id", "behavior_type")


def previous_event(events: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``previous_time`` and ``previous_behavior_type`` of the user's event before.

    Events are ordered by (time, item, behaviour). Events of hot users, NULL among them, are dealt into ranges of that order, so
    the sort of such a user spreads over as many tasks as it needs, equal rows too; the first event of a range takes the last one
    of the ranges before it. That step sees one row for each range and user. Everyone else is sorted in one window.
    """
    hot = hot_keys(events, "user_id", min_rows)
    previous = F.struct("time", "behavior_type")
    found = F.col("_previous")
    out = [*events.columns, found["time"].alias("previous_time"), found["behavior_type"].alias("previous_behavior_type")]

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_previous", F.lag(previous).over(Window.partitionBy("user_id").orderBy(*EVENT_ORDER)))

    if hot.isEmpty():
        return plain(events).select(*out)
    heavy = with_keys(events, hot, "user_id", "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    order = ["user_id", *EVENT_ORDER, "_tie"]
    ranges = materialize(heavy.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("user_id", "_range").orderBy(*EVENT_ORDER, "_tie")
    lagged = ranges.withColumns({"_previous": F.lag(previous).over(inside), "_first": F.row_number().over(inside) == 1})
    ends = ranges.groupBy("user_id", "_range").agg(F.max(F.struct(*EVENT_ORDER, "_tie")).alias("_end"))
    across = Window.partitionBy("user_id").orderBy("_range")
    last = F.lag("_end").over(across)
    carried = ends.select(
        F.col("user_id").alias("_user"), F.col("_range").alias("_at"),
        F.when(last.isNotNull(), F.struct(last["time"].alias("time"), last["behavior_type"].alias("behavior_type"))).alias("_carried"))
    # one row for each range and hot user: at most twice the number of partitions
    joined = lagged.join(F.broadcast(carried), F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("_range") == F.col("_at")), "left")
    joined = joined.withColumn("_previous", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_previous")))
    return plain(with_keys(events, hot, "user_id", "left_anti")).select(*out).unionByName(joined.select(*out))


def same_behavior_as_previous(events: DataFrame, **split) -> DataFrame:
    same = F.col("behavior_type") == F.col("previous_behavior_type")
    return previous_event(events, **split).withColumn("is_same_behavior", F.coalesce(same, F.lit(False)).cast("int"))


def behavior_sequence_features(events: DataFrame, **split) -> DataFrame:
    """Mean seconds between events and count of repeats of the previous behaviour, per user.

    The mean of consecutive gaps is (last - first) / (events - 1), so it needs no ordering.
    """
    known = events.select("user_id", *EVENT_ORDER).filter(F.col("time").isNotNull())
    flagged = same_behavior_as_previous(known, **split)
    span = seconds_between(F.min("time"), F.max("time"))
    return flagged.groupBy("user_id").agg(
        ratio_or_null(span, F.count("*") - 1).alias("avg_behavior_interval_seconds"),
        F.sum("is_same_behavior").alias("continuous_same_behavior_count"),
    )


def behavior_transition_matrix(events: DataFrame, **split) -> DataFrame:
    """Counts and probabilities of the next behaviour given the previous one."""
    known = events.select("user_id", *EVENT_ORDER).filter(F.col("time").isNotNull())
    pairs = previous_event(known, **split).filter(F.col("previous_behavior_type").isNotNull())
    counts = pairs.groupBy("previous_behavior_type", "behavior_type").agg(F.count("*").alias("transition_count"))
    # at most one row per pair of codes from here on
    total = F.sum("transition_count").over(Window.partitionBy("previous_behavior_type"))
    return counts.withColumn("previous_behavior_total", total).withColumn(
        "transition_probability", ratio_or_null(F.col("transition_count"), F.col("previous_behavior_total")))


def last_n_events(events: DataFrame, n: int = 50, key: str = "user_id") -> DataFrame:
    """The last ``n`` events of each user (or other key) with ``position`` 1 for the latest.

    The row_number filter becomes a group limit before the shuffle: a task sends at most ``n``
    rows per user, however many that user has.
    """
    latest = Window.partitionBy(key).orderBy(F.desc("time"), F.desc("item_id"), F.desc("behavior_type"))
    return events.withColumn("position", F.row_number().over(latest)).filter(F.col("position") <= n)


def last_n_sequence(
    events: DataFrame, n: int = 50,
    item: str = "item_id", category: str = "item_category", behavior: str = "behavior_type", key: str = "user_id",
) -> DataFrame:
    """Item, category and behaviour arrays of the last ``n`` events, oldest first."""
    rows = last_n_events(events, n, key).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("position")).alias("p"), F.col(item).alias("i"),
                                             F.col(category).alias("c"), F.col(behavior).alias("b")))).alias("_events"))
    return rows.select(
        key, F.col("_events.i").alias("item_seq"),
        F.col("_events.c").alias("cate_seq"), F.col("_events.b").alias("behavior_seq"))


def pad_sequence(df: DataFrame, column: str, length: int = 50) -> DataFrame:
    """Keeps the last ``length`` entries, fills with 0 on the left, adds ``<column>_length``."""
    kept = F.slice(F.col(column), F.greatest(F.size(column) - length + 1, F.lit(1)), length)
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(length) - F.size(column), F.lit(0)))
    return df.withColumns({
        f"{column}_length": F.least(F.size(column), F.lit(length)),
        column: F.concat(zeros, kept),
    })


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key under ``order_by``.

    A ``min`` over the ordered columns keeps one row per key and task before the shuffle.
    """
    rest = [*order_by, *[c for c in df.columns if c not in order_by and c not in keys]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
