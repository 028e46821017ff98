"""Samples of (user, item) pairs with behaviour sequences, cut by time."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import events_between, start_of
from ..functions.draws import take_by_hash
from ..functions.ordering import global_rank
from ..session import materialize
from .joins import hot_key_join, label_pair_join, lookup_join
from .sequences import last_n_sequence

ID_COLUMNS = ("user_id", "item_id", "item_category", "behavior_type")


def encode_ids(events: DataFrame) -> DataFrame:
    """Adds ``<c>_idx``: 1-based codes of users, items, categories and behaviours in string order.

    The distinct values of all four columns are ranked in one range shuffle.
    """
    text = events.select(*[F.col(c).cast("string").alias(c) for c in ID_COLUMNS])
    values = text.unpivot([], list(ID_COLUMNS), "_column", "_text").filter("_text is not null").distinct()
    codes = global_rank(values, ["_text"], ["_column"], "_code")
    encoded = events
    for c in ID_COLUMNS:
        kind = events.schema[c].dataType
        own = codes.filter(F.col("_column") == c).select(F.col("_text").cast(kind).alias(c), F.col("_code").alias(f"{c}_idx"))
        join = hot_key_join if c in ("user_id", "item_id") else lookup_join
        encoded = join(encoded, own, c)
    return encoded.select(*events.columns, *[f"{c}_idx" for c in ID_COLUMNS])


def choose_cutoffs(events: DataFrame, history_days: int = 7, label_days: int = 3, train_ratio: float = 0.7, val_ratio: float = 0.2) -> DataFrame:
    """One row: train, validation and test cutoff days."""
    span = events.agg(F.to_date(F.min("time")).alias("first"), F.to_date(F.max("time")).alias("last"))
    start, end = F.date_add("first", history_days), F.date_sub("last", label_days)
    total = F.greatest(F.date_diff(end, start), F.lit(3))

    def after(least, ratio):
        return F.date_add(start, F.greatest(F.lit(least), F.floor(total * F.lit(ratio)).cast("int")))

    return span.filter(end > start).select(
        after(1, train_ratio).alias("train_cutoff"),
        F.least(after(2, train_ratio + val_ratio), F.date_sub(end, 1)).alias("val_cutoff"),
        end.alias("test_cutoff"))


def build_windows(
    events: DataFrame, cutoffs: dict[str, Column], history_days: int = 7, label_days: int = 3, negative_ratio: int = 3, max_len: int = 50,
    seed: int = K.SEED, with_sequences: bool = True,
) -> DataFrame:
    """Pairs seen in the history window before each cutoff, labelled by a purchase in the label window after it.

    Every event goes into the windows that hold it, so one scan, one labelling and one draw serve all cutoffs. Negatives are drawn
    to at most ``negative_ratio`` per positive. The labelled pairs are fixed once because counting, cutting and drawing read them.
    """
    spans = [(F.date_sub(day, history_days), F.date_add(day, label_days)) for day in cutoffs.values()]
    near = functools.reduce(lambda a, b: a | b, [(F.col("time") >= start_of(a)) & (F.col("time") < start_of(b)) for a, b in spans])
    windows = F.array(*[F.struct(F.lit(name).alias("split"), day.cast("date").alias("cutoff_time")) for name, day in cutoffs.items()])
    placed = events.filter(near).select("*", F.explode(windows).alias("_w")).select(*events.columns, "_w.split", "_w.cutoff_time")
    who = F.when(F.col("user_id").isNotNull(), F.concat_ws("|", "split", F.col("user_id").cast("string")))
    history = events_between(placed, F.date_sub("cutoff_time", history_days), F.col("cutoff_time")).withColumn("_who", who)
    future = events_between(placed, F.col("cutoff_time"), F.date_add("cutoff_time", label_days))
    pairs = history.select("user_id", "item_id", "item_category", "cutoff_time", "split").distinct()
    labelled = materialize(label_pair_join(pairs, future.filter(F.col("behavior_type") == K.BUY), ["split"]))

    counts = labelled.groupBy("split").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    wanted = F.least("n", F.col("p") * negative_ratio)
    negatives = F.when((F.col("p") > 0) & F.lit(negative_ratio > 0), wanted).otherwise(F.col("n"))
    quotas = counts.select("split", F.inline(F.array(
        F.struct(F.lit(0).alias("label"), negatives.alias("quota")),
        F.struct(F.lit(1).alias("label"), F.col("p").alias("quota")))))
    drawn = take_by_hash(labelled, ["user_id", "item_id", "item_category"], quotas, ["split", "label"], seed)
    drawn = drawn.select("user_id", "item_id", "item_category", "label", "cutoff_time", "split")
    if not with_sequences:
        return drawn
    return hot_key_join(drawn.withColumn("_who", who), last_n_sequence(history, max_len, key="_who"), "_who").drop("_who")


def build_samples(events: DataFrame, cutoff: Column, split: str, **options) -> DataFrame:
    """``build_windows`` for one cutoff."""
    return build_windows(events, {split: cutoff}, **options)


def build_time_split_dataset(events: DataFrame, **options) -> DataFrame:
    """Train, validation and test samples at the three chosen cutoffs."""
    windows = {k: options[k] for k in ("history_days", "label_days") if k in options}
    days = choose_cutoffs(events, **windows).first()  # one row
    cutoffs = {name: F.lit(days[f"{name}_cutoff"] if days else None).cast("date") for name in ("train", "val", "test")}
    return build_windows(events, cutoffs, **options)
