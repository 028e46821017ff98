"""Connected components of a graph given as pairs, by alternating large and small stars.

Every step is an aggregate and a join over the pairs and ends in a checkpoint; neither pairs nor components reach the driver. A hub
with many neighbours is one row of the aggregate; its pairs spread over tasks, and the join may split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _mark(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) of every node in ``pairs`` (a, b); a component is named by its smallest node."""
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = materialize(pairs)
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        lower = large.join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = lower.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        pairs = materialize(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = _mark(pairs)
        if now == mark:
            break
        mark = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
