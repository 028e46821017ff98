"""Bounded samples for fitting, drawn by a hash of the key: the same rows in any partitioning and after a retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOTS = 1 << 30


def slot(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_SLOTS))


def about(df: DataFrame, key: str, rows: int, seed: int = 1) -> DataFrame:
    """All rows if there are at most ``rows``, else about ``rows`` of them. Counts ``df`` once."""
    total = df.count()
    return df if total <= rows else df.filter(slot(key, seed) < int(_SLOTS * rows / total))


def about_each(df: DataFrame, key: str, group: str, rows: int, seed: int = 1) -> DataFrame:
    """About ``rows`` rows of each value of ``group``, of which there are few; all where a value has no more."""
    shares = df.groupBy(group).agg(F.least(F.lit(1.0), F.lit(float(rows)) / F.count("*")).alias("_share"))
    # one row per value of the group
    return df.join(shares.hint("broadcast"), group).filter(slot(key, seed) < F.col("_share") * _SLOTS).drop("_share")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor
