"""Joins on group columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # of a side that is sent to every task


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on group columns where NULL is a group like any other; a ``right`` of few rows is broadcast."""
    renamed = right.withColumnsRenamed({c: f"_by_{c}" for c in by})
    renamed = F.broadcast(renamed) if right.count() <= BROADCAST_ROWS else renamed
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_by_{c}" for c in by])
