"""Synthetic minority rows between nearest neighbours, with a neighbour search that Spark partitions.

Points are dealt into blocks by random projections, in several independent ways ("trees"): a block with more than ``size`` points is
cut at the quartiles of their projections on one random direction, as often as it takes, so blocks are neither large nor nearly
empty. Points whose projections don't spread (many equal ones) are dealt by a hash instead, which leaves equal points enough of their
like. Inside a block all distances are computed; the nearest few of every tree are merged, and then the neighbours of these
neighbours are tried too, which finds most of what a cut has separated. Only keys and distances move in the merges.

Nothing reaches the driver but the number of blocks that are still too large.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.draws import sample_exact
from ..functions.groups import join_groups
from ..session import materialize

TREES = 6
BLOCK = 512  # points that meet in a task


def _projection(columns: int, trees: int, seed: int, round_: int):
    """The product of a point with the direction of its tree."""
    directions = []
    for tree in range(trees):
        rng = random.Random(f"{seed}-{round_}-{tree}")
        directions.append(F.array(*[F.lit(rng.gauss(0.0, 1.0)) for _ in range(columns)]))
    product = F.zip_with("_v", F.element_at(F.array(*directions), F.col("tree") + 1), lambda x, w: x * w)
    return F.aggregate(product, F.lit(0.0), lambda total, x: total + x)


def blocks(points: DataFrame, columns: int, k: int, trees: int = TREES, size: int = BLOCK, seed: int = K.SEED) -> DataFrame:
    """(tree, leaf, _key, _v): every point of ``points`` (_key, _v) in one block of each tree; at most ``size`` points a block, more than ``k`` where there are as many."""
    laid = materialize(points.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).cast("bigint").alias("leaf"), "_key", "_v"))
    round_ = 0
    while True:
        large = materialize(laid.groupBy("tree", "leaf").agg(F.count("*").alias("_n")).filter(F.col("_n") > size).select("tree", "leaf"))
        if large.isEmpty():
            return laid
        projected = laid.withColumn("_p", _projection(columns, trees, seed, round_))
        cuts = join_groups(projected, large, ["tree", "leaf"]).groupBy("tree", "leaf").agg(
            F.percentile_approx("_p", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias("_cuts"))
        cell = sum(((F.col("_p") > F.get("_cuts", F.lit(i))).cast("int") for i in range(1, 3)), (F.col("_p") > F.get("_cuts", F.lit(0))).cast("int"))
        placed = materialize(join_groups(projected, materialize(cuts), ["tree", "leaf"], "left").select("tree", "leaf", "_key", "_v", cell.alias("_cell")))
        cells = placed.filter(F.col("_cell").isNotNull()).groupBy("tree", "leaf", "_cell").agg(F.count("*").alias("_n"))
        flat = cells.groupBy("tree", "leaf").agg(F.min("_n").alias("_least"), F.count("*").alias("_cells"))
        flat = materialize(flat.filter((F.col("_least") <= k) | (F.col("_cells") == 1)).select("tree", "leaf", F.lit(True).alias("_flat")))
        dealt = F.pmod(F.xxhash64("_key", F.lit(round_)), F.lit(4)).cast("int")
        next_ = F.xxhash64("leaf", F.lit(round_), F.when(F.col("_flat"), dealt + 4).otherwise(F.col("_cell")))
        laid = materialize(join_groups(placed, flat, ["tree", "leaf"], "left").select(
            "tree", F.when(F.col("_cell").isNull(), F.col("leaf")).otherwise(next_).alias("leaf"), "_key", "_v"))
        round_ += 1


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of (_base, _other, _d); equal distances go by key. Limited before the shuffle."""
    nearest = Window.partitionBy("_base").orderBy("_d", "_other")
    return found.groupBy("_base", "_other").agg(F.min("_d").alias("_d")).withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= k)


def nearest(points: DataFrame, bases: DataFrame, columns: int, k: int, trees: int = TREES, size: int = BLOCK, seed: int = K.SEED) -> DataFrame:
    """(_base, _other, _d, _place): the ``k`` nearest other points (_key, _v) of the points named in ``bases`` (_key).

    Up to ``size`` points the search is exact; beyond, it finds nearly all (the tests ask for 0.9 of brute force, at blocks of 128 among 3,000 points).
    """
    wide = 2 * k  # more than is asked for, so that the second step has somewhere to go

    def inside(frame: pd.DataFrame) -> pd.DataFrame:
        values, keys = np.stack(frame["_v"].to_numpy()), frame["_key"].to_numpy()
        squares = (values**2).sum(1)
        distance = squares[:, None] - 2 * values @ values.T + squares[None, :]
        np.fill_diagonal(distance, np.inf)
        take = min(wide + 3, len(keys) - 1)  # a few more, as these sums round
        if take < 1:
            return pd.DataFrame({"_base": [], "_other": [], "_d": []})
        close = np.argpartition(distance, take - 1, axis=1)[:, :take]
        exact = ((values[:, None, :] - values[close]) ** 2).sum(2) if values.size * take < 1 << 22 else np.stack([((v - values[c]) ** 2).sum(1) for v, c in zip(values, close)])
        return pd.DataFrame({"_base": np.repeat(keys, take), "_other": keys[close].ravel(), "_d": exact.ravel()})

    laid = blocks(points, columns, k, trees, size, seed)
    found = laid.groupBy("tree", "leaf").applyInPandas(inside, "_base string, _other string, _d double")
    near = materialize(_kept(found, wide))
    if points.count() > size:
        # neighbours of neighbours: at most 3 k * k a point, of which those already known drop out before the vectors are fetched
        step = near.select(F.col("_base").alias("_middle"), F.col("_other").alias("_next"))
        back = near.select(F.col("_other").alias("_middle"), F.col("_base").alias("_next"))
        close = near.filter(F.col("_place") <= k)
        reached = close.select("_base", F.col("_other").alias("_middle")).join(step.unionByName(_few(back, k)), "_middle")
        fresh = reached.filter("_base <> _next").select("_base", F.col("_next").alias("_other")).distinct().join(near, ["_base", "_other"], "left_anti")
        one = fresh.join(points.select(F.col("_key").alias("_base"), F.col("_v").alias("_x")), "_base")
        two = one.join(points.select(F.col("_key").alias("_other"), F.col("_v").alias("_y")), "_other")
        apart = F.aggregate(F.zip_with("_x", "_y", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
        near = materialize(_kept(near.select("_base", "_other", "_d").unionByName(two.select("_base", "_other", apart.alias("_d"))), k))
    return near.filter(F.col("_place") <= k).join(bases.select(F.col("_key").alias("_base")), "_base", "left_semi")


def _few(back: DataFrame, k: int) -> DataFrame:
    """At most ``k`` of the points that have a point among their neighbours: tries for the search, not results."""
    drawn = Window.partitionBy("_middle").orderBy(F.xxhash64("_next"), "_next")
    return back.withColumn("_place", F.row_number().over(drawn)).filter(F.col("_place") <= k).drop("_place")


def smote_oversample(
    train: DataFrame, columns: Sequence[str], label: str = "label", key: str = "user_id",
    neighbors: int = 5, seed: int = K.SEED, trees: int = TREES, size: int = BLOCK,
) -> DataFrame:
    """``columns`` and label of all rows, and synthetic minority rows until both labels are equally frequent.

    A synthetic row lies between a minority row and one of its nearest minority neighbours; which rows, which neighbour and how far
    come from hashes, so a rerun gives the same rows. Of minority rows that repeat a key the least (by its columns) is a base and a
    neighbour; rows with a missing value in ``columns`` are neither. At least two such rows are needed unless the labels are even.
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}  # a row for each label
    if not {0, 1} <= set(counts):
        raise ValueError("both labels are needed to oversample")
    minority = 1 if counts[1] <= counts[0] else 0
    missing = abs(counts[0] - counts[1])
    columns = list(columns)
    result = train.select(*[F.col(c).cast("double").alias(c) for c in columns], label)
    if missing == 0:
        return result
    values = F.array(*[F.col(c).cast("double") for c in columns])
    known = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x))
    few = train.filter((F.col(label) == minority) & F.coalesce(known, F.lit(False)))
    few = few.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), values.alias("_v"))
    few = materialize(few.groupBy("_key").agg(F.min("_v").alias("_v")))
    rows = few.count()
    if rows < 2:
        raise ValueError("the minority needs at least 2 rows")

    # each base counts floor(missing / rows) times, some once more
    full, rest = divmod(missing, rows)
    bases = few.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(full)))) if full else None
    if rest:
        more = sample_exact(few.select("_key"), rest, ["_key"], seed)
        last = few.join(more, "_key", "left_semi").withColumn("_copy", F.lit(full + 1))
        bases = last if bases is None else bases.unionByName(last)
    near = nearest(few, bases.select("_key").distinct(), len(columns), neighbors, trees, size, seed)
    listed = near.groupBy("_base").agg(F.sort_array(F.collect_list(F.struct("_place", "_other"))).alias("_near"))  # k entries

    pick = F.pmod(F.xxhash64("_key", "_copy", F.lit(seed)), F.size("_near")).cast("int")
    gap = (F.pmod(F.xxhash64("_key", "_copy", F.lit(seed + 1)), F.lit(2**31)) + 0.5) / F.lit(float(2**31))
    joined = bases.join(listed, F.col("_key") == F.col("_base")).select("_key", "_copy", "_v", F.get("_near", pick)["_other"].alias("_other"))
    joined = joined.join(few.select(F.col("_key").alias("_other"), F.col("_v").alias("_to")), "_other")
    synthetic = joined.select(
        *[(F.get("_v", F.lit(j)) + gap * (F.get("_to", F.lit(j)) - F.get("_v", F.lit(j)))).alias(c) for j, c in enumerate(columns)],
        F.lit(minority).cast(train.schema[label].dataType).alias(label))
    return result.unionByName(synthetic)
