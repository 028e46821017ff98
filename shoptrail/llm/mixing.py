"""Mixing sources to target weights by entropy balancing.

A document's size is its number of words. Sources share the total size by weight; no target exceeds ``most`` times its source's
size, and what is cut off is shared again by weight. Rates r of documents stay as close as possible, in relative entropy, to one
copy of each, while the words of each source sum to its target and no rate exceeds ``most``. The dual is convex with one number
for each source, and its solution tilts rates exponentially: r = min(most, exp(a * size / mean size of the source)).

Newton's method finds the numbers of all sources at once, each step one aggregate over counts of (source, size), to which
documents are summed up first, so a step doesn't grow with the number of documents; steps that leave the bracket are halved.
Rates become whole copies from the largest size of a source down, each size taking over the words the sizes before it owe, so the
words of a source end within about half its smallest documents of the target. Within one (source, size) a hash of the document
decides who gets one copy more; groups above ``GROUP`` documents are dealt into buckets first, so none meets in one task.

Null and empty texts have size 0 and are never taken. A null source is a source of its own, after all others. Equal hashes are
ordered by key. Repeated rows count as rows; reruns agree. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import global_rank
from ..session import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
GROUP = 1_000
STEPS = 60
BROADCAST_ROWS = 1_000_000  # of two or three numbers each
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("bigint")


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return df.hint("broadcast") if rows <= BROADCAST_ROWS else df


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, docs, target) from one row per source with its size; sources by code point, null last."""
    keyed = sizes.withColumn("_last", F.col("source").isNull().cast("int"))
    ranked = global_rank(keyed, ["_last", "source"], name="_rank")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("_weight", F.element_at(listed, (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = materialize(ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most))))
    level, rise = 0.0, 0.0
    while True:  # the level rises until no further source reaches its cap: at most one round for each source, a few in practice
        closed = F.col("_cap") < F.col("_weight") * F.lit(level)
        got = ranked.agg(
            F.sum(F.col("source_size").cast("double")).alias("all"), F.sum(F.when(closed, F.col("_cap"))).alias("held"),
            F.sum(F.when(~closed, F.col("_weight"))).alias("open")).first()
        rise = ((got["all"] or 0.0) - (got["held"] or 0.0)) / got["open"] if got["open"] else level
        if rise <= level:
            break
        level = rise
    return ranked.select("source", "source_size", "docs", F.least(F.col("_cap"), F.col("_weight") * F.lit(level)).alias("target"))


def tilts(counts: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """(source, mean, tilt) such that the rates' words meet the targets; ``counts`` has (source, size, n)."""
    state = goals.filter("target > 0").select(
        "source", "target", (F.col("source_size") / F.col("docs")).alias("mean"), F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
        (F.col("target") >= F.col("source_size") * F.lit(float(most))).alias("full"))
    state = materialize(state)
    rows = state.count()
    for _ in range(STEPS):
        if not rows or not state.filter(~F.col("full")).filter("abs(high - low) > 0").limit(1).count():
            break
        at = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * at, F.lit(50.0))))
        tokens = F.col("n") * F.col("size") * rate
        met = counts.withColumnRenamed("source", "_source").join(
            _if_small(state, rows), F.col("_source").eqNullSafe(F.col("source"))).groupBy("source").agg(
            F.sum(tokens).alias("_got"), F.sum(F.when(rate < most, tokens * at).otherwise(0.0)).alias("_slope"))
        joined = state.withColumnRenamed("source", "_s").join(met, F.col("_s").eqNullSafe(F.col("source")), "left").drop("source").withColumnRenamed("_s", "source")
        near = F.abs(F.col("_got") / F.col("target") - 1) < 1e-9
        low = F.when(F.col("_got") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("_got") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.when((F.col("_slope") > 0) & (F.col("_got") > 0), F.col("_got") * F.log(F.col("_got") / F.col("target")) / F.col("_slope"))
        moved = joined.withColumns({"_low": low, "_high": high, "_newton": newton})
        inside = F.col("_newton").isNotNull() & (F.col("_newton") > F.col("_low")) & (F.col("_newton") < F.col("_high"))
        middle = (F.when(F.col("_low") == float("-inf"), F.col("_high") * 2 - F.lit(1.0))
                  .when(F.col("_high") == float("inf"), F.col("_low") * 2 + F.lit(1.0)).otherwise((F.col("_low") + F.col("_high")) / 2))
        done = near | F.col("full") | F.col("_got").isNull()
        state = materialize(moved.select(
            "source", "target", "mean", F.when(done, F.col("tilt")).when(inside, F.col("_newton")).otherwise(middle).alias("tilt"),
            F.when(done, F.col("tilt")).otherwise(F.col("_low")).alias("low"), F.when(done, F.col("tilt")).otherwise(F.col("_high")).alias("high"), "full"))
    return state.select("source", "mean", "tilt", "full")


def _copies(sizes: np.ndarray, n: np.ndarray, rates: np.ndarray, most: int) -> np.ndarray:
    """Whole copies for each size, from the largest down; what one size owes or overdraws the next ones even out."""
    taken, owed = np.zeros(len(sizes), np.int64), 0.0
    for i in np.argsort(-sizes, kind="stable"):
        if sizes[i] > 0:
            taken[i] = min(max(round((n[i] * rates[i] * sizes[i] + owed) / sizes[i]), 0), most * n[i])
            owed += (n[i] * rates[i] - taken[i]) * sizes[i]
    return taken


def mix(sized: DataFrame, keys: Sequence[str], weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sized`` has ``keys``, source and size; adds source_size, target and copies to each of its rows."""
    sized = materialize(sized.select(*keys, "source", "size"))
    counts = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = materialize(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")), weights, most))
    tilted = tilts(counts, goals, most)
    sources = goals.count()
    rated = counts.withColumnRenamed("source", "_source").join(_if_small(tilted, sources), F.col("_source").eqNullSafe(F.col("source")), "left").select(
        F.col("_source").alias("source"), "size", "n",
        F.when(F.col("tilt").isNull(), 0.0).when(F.col("full"), F.lit(float(most)))
        .otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))).alias("rate"))

    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        return group.assign(k=_copies(group["size"].to_numpy(), group["n"].to_numpy(), group["rate"].to_numpy(), most))[["source", "size", "n", "k"]]

    # one group holds one row for each size that occurs in a source
    whole = materialize(rated.groupBy("source").applyInPandas(rounded, "source string, size long, n long, k long"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    listed = _if_small(whole, whole.count())
    dealt = sized.alias("d").join(listed.alias("w"), same(_of("d"), _of("w")) & (F.col("d.size") == F.col("w.size"))).select(
        *[F.col(f"d.{c}").alias(c) for c in keys], F.col("d.source").alias("source"), F.col("d.size").alias("size"), "n", "k",
        F.xxhash64(*[F.col(f"d.{c}") for c in keys], F.lit(11)).alias("_h"))
    dealt = dealt.withColumn("_bucket", F.pmod(F.shiftright("_h", 7), F.ceil(F.col("n") / GROUP)))
    held = dealt.groupBy("source", "size", "_bucket").agg(F.count("*").alias("_held"), F.first("n").alias("n"), F.first("k").alias("k"))
    so_far = F.sum("_held").over(Window.partitionBy("source", "size").orderBy("_bucket"))
    extra = F.col("k") % F.col("n")
    share = lambda upto: F.floor(extra * upto / F.col("n"))
    more = held.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("_bucket").alias("_b"),
        (share(so_far) - share(so_far - F.col("_held"))).alias("_more"))
    place = F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_h", *keys))
    numbered = dealt.withColumn("_place", place)
    joined = numbered.join(more, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & (F.col("_bucket") == F.col("_b")))
    copied = joined.select(*keys, "source", "size", (F.floor(F.col("k") / F.col("n")) + (F.col("_place") <= F.col("_more")).cast("int")).cast("bigint").alias("copies"))
    ends = _if_small(goals.select(F.col("source").alias("_source"), "source_size", "target"), sources)
    return copied.join(ends, F.col("source").eqNullSafe(F.col("_source"))).select(*keys, "source", "size", "source_size", "target", "copies")


class _of:
    def __init__(self, alias: str) -> None:
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they came with."""
    # a row is known by its key, the hash of all its columns and its number among rows that agree in all of them
    names = ["__id__", "__h__", "__nth__"]
    marked = docs.withColumns({"__id__": F.to_json(F.struct(F.col(key))), "__h__": F.xxhash64(*docs.columns)})
    marked = marked.withColumn("__nth__", F.row_number().over(Window.partitionBy("__id__", "__h__").orderBy("__h__")))
    sized = marked.select(*names, F.col(source).alias("source"), words(F.col(text)).alias("size"))
    taken = mix(sized, names, **options).filter("copies > 0").select(*names, "copies")
    repeated = marked.join(taken, names)
    return repeated.withColumn("__copy__", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)
