"""Joins. Everything is an equi join; heavy keys don't meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.groups import BROADCAST_ROWS
from ..session import materialize

HOT_ROWS = 1_000_000  # below this many rows no key is worth splitting


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """(key) of the heavy keys. One pass over the key column; counts are combined map-side. NULL can be a hot key."""
    return heavy_of(materialize(df.groupBy(key).agg(F.count("*").alias("_n"))), key, min_rows)


def heavy_of(counts: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of ``counts`` (key, _n) with more than ``min_rows`` rows and, if these are many, more than an average partition.

    So there are at most as many as shuffle partitions, whatever the size of the data; they stay a table.
    """
    heavy = counts.filter(F.col("_n") > min_rows)
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if heavy.count() > parts:
        total = counts.agg(F.sum("_n")).first()[0]
        heavy = heavy.filter(F.col("_n") * parts > total)
    return heavy.select(key)


def with_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or isn't (``left_anti``) in ``keys``; NULL equals NULL.

    ``keys`` comes from ``hot_keys``: one row for each partition at most.
    """
    named = F.broadcast(keys.withColumnRenamed(key, "_key"))
    return df.join(named, F.col(key).eqNullSafe(F.col("_key")), how)


def hot_key_join(
    big: DataFrame, side: DataFrame, key: str, how: str = "left", min_rows: int = HOT_ROWS, hot: DataFrame | None = None,
) -> DataFrame:
    """Join a fact-sized table to a smaller side on one key.

    Without hot keys this is the plain join. Rows of hot keys stay where they are and meet the side's rows of those keys in a
    broadcast, if these are few by count (with one row per key they are at most as many as partitions); every other row moves
    once, as in the plain join. Where the side has more rows for hot keys, the plain join is left to AQE's skew handling.
    """
    if hot is None:
        hot = hot_keys(big, key, min_rows)
    if hot.isEmpty():
        return big.join(side, key, how)
    few = materialize(with_keys(side, hot, key, "left_semi"))
    if few.count() > BROADCAST_ROWS:
        return big.join(side, key, how)
    rest = with_keys(big, hot, key, "left_anti").join(side, key, how)
    heavy = with_keys(big, hot, key, "left_semi").join(F.broadcast(few), key, how)
    return rest.unionByName(heavy)


def small_side_join(df: DataFrame, side: DataFrame, on, how: str = "left") -> DataFrame:
    """Join to a lookup table: broadcast if it is small by count, so a table of few keys never moves the fact."""
    return df.join(F.broadcast(side) if side.count() <= BROADCAST_ROWS else side, on, how)


def left_join_user(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Chain of left joins on ``user_id``. Inputs are one row per user, so no key is heavy,
    and after the first shuffle the chain stays partitioned by ``user_id``."""
    for other in others:
        first = first.join(other, "user_id", "left")
    return first


def left_join_item(items: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        items = items.join(other, "item_id", "left")
    return items


def left_join_category(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Category facts for items; a NULL category matches a NULL category."""
    right = categories.withColumnRenamed("item_category", "_category")
    return small_side_join(items, right, F.col("item_category").eqNullSafe(F.col("_category"))).drop("_category")


def total_by_group_join(counts: DataFrame, group: str, value: str, total: str) -> DataFrame:
    """Adds the group total to finer counts, for counts that are already aggregated."""
    totals = counts.groupBy(group).agg(F.sum(value).alias(total))
    return counts.join(totals, group, "left")


def fact_dim_join(fact: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Events per category through the item dimension.

    The fact is counted per item before the join, so a hot item is one row. An item with two
    categories counts for both, as the plain join does.
    """
    per_item = fact.groupBy("item_id").agg(F.count("*").alias("_n"))
    joined = per_item.join(dim_item, "item_id")
    return joined.groupBy("item_category").agg(F.sum("_n").alias("behavior_count"))


def semi_join_users(df: DataFrame, users: DataFrame) -> DataFrame:
    return df.join(users.select("user_id"), "user_id", "left_semi")


def flag_users(df: DataFrame, users: DataFrame, name: str) -> DataFrame:
    """0/1 column: is the user in the set?"""
    marks = users.select("user_id").distinct().withColumn("_mark", F.lit(1))
    return df.join(marks, "user_id", "left").withColumn(name, F.coalesce("_mark", F.lit(0))).drop("_mark")


def label_pair_join(candidates: DataFrame, buyers: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Label 1 for (user, item) pairs, within equal ``also``, found among the buyers, else 0."""
    pair = ["user_id", "item_id", *also]
    marks = buyers.select(*pair).distinct().withColumn("_mark", F.lit(1))
    joined = candidates.join(marks, pair, "left")
    return joined.withColumn("label", F.coalesce("_mark", F.lit(0))).drop("_mark")


def attach_features(predictions: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Predictions with the features of their key; the first row of a repeated key counts."""
    from .sequences import first_per_key

    order = [c for c in features.columns if c != key]
    unique = first_per_key(features, [key], order)
    return hot_key_join(predictions, unique, key)


def lookup_join(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Dictionary lookup as a join; NULL keys find the NULL entry."""
    right = table.withColumnRenamed(key, "_key")
    return small_side_join(df, right, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def union_frames(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for other in frames[1:]:
        result = result.unionByName(other)
    return result


def union_optional(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for other in frames[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select("user_id").distinct()
