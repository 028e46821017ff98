"""Deterministic draws: rows in the order of a hash of their key.

The draw does not depend on partitioning or on retries, and needs no global sort: counts per
hash prefix locate the cut, prefixes grow until the cut's slot is small, that slot is ranked,
and the draw itself is a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .constants import SEED
from .groups import join_groups

_STEP = 4  # hex digits that the prefix grows by: 65,536 slots each time
_SLOT_ROWS = 100_000  # rows of a slot that one task may rank
_DIGITS = 32
_EVERYTHING = "~"  # sorts after every hex digest


def hash_order(keys: Sequence[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_cutoffs(
    df: DataFrame, keys: Sequence[str], quotas: DataFrame, by: Sequence[str], seed: int = SEED, each: Sequence[str] = (),
) -> DataFrame:
    """Per group the digest of its ``quota``-th row, as ``(by…, each…, quota, cutoff, at_cutoff, ties)``.

    ``quotas`` has one row per group, or one for each ``each`` in it, which are all found in one search; NULL is a group. ``keys`` identify a row; where they repeat, ``ties`` rows share the
    cutoff and the quota takes ``at_cutoff`` of them.
    """
    by, each = list(by), list(each)
    digests = df.select(*by, hash_order(keys, seed).alias("_h"))
    edge = quotas.select(*by, *each, F.col("quota").alias("_need"), F.lit("").alias("_slot"), F.lit(None).cast("bigint").alias("_size"))
    for length in range(_STEP, _DIGITS + 1, _STEP):
        prefix = F.substring("_h", 1, length)
        slotted = digests.withColumn("_slot", F.substring("_h", 1, length - _STEP))
        inside = slotted if length == _STEP else join_groups(slotted, edge.select(*by, "_slot").distinct(), [*by, "_slot"])
        slots = inside.withColumn("_next", prefix).groupBy(*by, "_slot", "_next").agg(F.count("*").alias("_n"))
        earlier = Window.partitionBy(*by, "_slot").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        slots = slots.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        edge = materialize(join_groups(slots, edge.select(*by, *each, "_slot", "_need"), [*by, "_slot"]).filter(
            (F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_n"))
        ).select(*by, *each, (F.col("_need") - F.col("_before")).alias("_need"), F.col("_next").alias("_slot"), F.col("_n").alias("_size")))
        if length == _DIGITS or edge.filter(F.col("_size") > _SLOT_ROWS).isEmpty():
            break
    # at most one slot per group, of a bounded number of rows unless a key repeats more often than that
    inside = join_groups(digests.withColumn("_slot", F.substring("_h", 1, length)), edge.select(*by, "_slot").distinct(), [*by, "_slot"])
    position = Window.partitionBy(*by, "_slot").orderBy("_h")
    counted = inside.groupBy(*by, "_slot", "_h").agg(F.count("*").alias("ties"))
    below = F.coalesce(F.sum("ties").over(position.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = join_groups(counted.withColumn("_below", below), edge.drop("_size"), [*by, "_slot"])
    cut = placed.filter((F.col("_below") < F.col("_need")) & (F.col("_need") <= F.col("_below") + F.col("ties")))
    cut = cut.select(*by, *each, "_h", (F.col("_need") - F.col("_below")).alias("at_cutoff"), "ties")
    return join_groups(quotas, cut, [*by, *each], "left").select(
        *by, *each, "quota",
        F.when(F.col("quota") <= 0, "").otherwise(F.coalesce("_h", F.lit(_EVERYTHING))).alias("cutoff"), "at_cutoff", "ties")


def take_by_hash(df: DataFrame, keys: Sequence[str], quotas: DataFrame, by: Sequence[str], seed: int = SEED) -> DataFrame:
    """The first ``quota`` rows of each group in hash order; among rows that repeat a key, in the order of all their columns."""
    by = list(by)
    cutoffs = materialize(hash_cutoffs(df, keys, quotas, by, seed))
    digest = hash_order(keys, seed)
    joined = join_groups(df, cutoffs.drop("quota"), by)
    if cutoffs.filter("ties > at_cutoff").isEmpty():
        return joined.filter(digest <= F.col("cutoff")).select(*df.columns)
    whole = (F.col("ties") <= F.col("at_cutoff")) | F.col("ties").isNull()
    sure = joined.filter((digest < F.col("cutoff")) | (whole & (digest == F.col("cutoff"))))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64(*df.columns)))
    tied = joined.filter(~whole & (digest == F.col("cutoff"))).withColumn("_place", place).filter(F.col("_place") <= F.col("at_cutoff"))
    return sure.select(*df.columns).unionByName(tied.select(*df.columns))


def sample_exact(df: DataFrame, n: int, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows."""
    tagged = df.withColumn("_all", F.lit(1))
    quotas = df.sparkSession.range(1).select(F.lit(1).alias("_all"), F.lit(n).cast("bigint").alias("quota"))
    return take_by_hash(tagged, keys, quotas, ["_all"], seed).select(*df.columns)


def sample_cap(df: DataFrame, max_rows: int, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """``df`` itself when ``max_rows`` is 0, else at most ``max_rows`` rows."""
    return sample_exact(df, max_rows, keys, seed) if max_rows > 0 else df
