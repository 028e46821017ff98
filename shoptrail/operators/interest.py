"""Purchase scores from a user's recent events and a target item.

History items are weighted by how well their factor vector matches the target's (softmax of
inner products), which gives an interest summary per (user, item) pair for boosted trees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import weight_of
from ..session import materialize
from .boosting import BoostedTrees
from .classifiers import score, train_gbt_depthwise
from .joins import hot_key_join

INTEREST_FEATURES = (
    "history_length", "attended_weight", "attended_same_category", "best_match", "mean_match",
    "same_item_events", "same_category_events", "same_item_weight", "history_buys", "last_weight",
)


SAMPLE_KEYS = ("user_id", "item_id", "item_category", "label", "cutoff_time", "split")


def item_vectors(item_factors: DataFrame) -> DataFrame:
    """Factor columns as one array of unit length per item."""
    names = [c for c in item_factors.columns if c != "item_id"]
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in names[1:]), F.col(names[0]) * F.col(names[0])))
    units = item_factors.withColumn("_norm", norm)
    return units.select("item_id", F.array(*[F.coalesce(F.try_divide(F.col(c), F.col("_norm")), F.lit(0.0)) for c in names]).alias("vector"))


def interest_features(samples: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Interest features of samples that carry item, category and behaviour arrays.

    Vectors are looked up once per (user, split) history of at most 50 events, not once per
    sample; both lookups split heavy items and users. Each sample is then compared with its
    history row by row, and its rows are summed again in the task that made them. The vectors
    have unit length, so the softmax needs no shift.
    """
    vectors = item_vectors(item_factors)
    width = len(item_factors.columns) - 1
    owned = materialize(samples).withColumn("_who", F.concat_ws("|", F.col("user_id").cast("string"), "split"))
    history = owned.groupBy("_who").agg(F.first(F.arrays_zip("item_seq", "cate_seq", "behavior_seq")).alias("_events"))
    events = history.select("_who", F.posexplode("_events").alias("_at", "_e")).select(
        "_who", "_at", F.col("_e.item_seq").alias("item_id"), F.col("_e.cate_seq").alias("_c"), F.col("_e.behavior_seq").alias("_b"))
    found = hot_key_join(events, vectors, "item_id")
    memory = found.groupBy("_who").agg(F.collect_list(F.struct(
        "_at", F.col("item_id").alias("i"), F.col("_c").alias("c"), F.col("_b").alias("b"), F.col("vector").alias("v"))).alias("_memory"))
    target = hot_key_join(owned.select(*SAMPLE_KEYS, "_who"), vectors, "item_id").withColumnRenamed("vector", "_target")
    rows = hot_key_join(target, memory, "_who").select(*SAMPLE_KEYS, "_target", F.explode_outer("_memory").alias("_m"))

    products = [F.get("_target", F.lit(j)) * F.get("_m.v", F.lit(j)) for j in range(width)]
    compared = rows.select(
        *SAMPLE_KEYS, F.col("_m._at").alias("_at"),
        F.coalesce(sum(products[1:], products[0]), F.lit(0.0)).alias("_match"),
        F.coalesce(weight_of(F.col("_m.b"), K.VALUE_WEIGHTS).cast("double"), F.lit(0.0)).alias("_w"),
        (F.col("_m.c") == F.col("item_category")).cast("double").alias("_same_c"),
        (F.col("_m.i") == F.col("item_id")).cast("double").alias("_same_i"),
        (F.col("_m.b") == K.BUY).cast("double").alias("_buy"))
    e = F.exp("_match")
    summed = compared.groupBy(*SAMPLE_KEYS).agg(
        F.count("_at").cast("double").alias("history_length"),
        F.try_divide(F.sum(e * F.col("_w")), F.sum(e)).alias("attended_weight"),
        F.try_divide(F.sum(e * F.col("_same_c")), F.sum(e)).alias("attended_same_category"),
        F.max("_match").alias("best_match"), F.avg("_match").alias("mean_match"),
        F.sum("_same_i").alias("same_item_events"), F.sum("_same_c").alias("same_category_events"),
        F.sum(F.col("_same_i") * F.col("_w")).alias("same_item_weight"), F.sum("_buy").alias("history_buys"),
        F.max_by("_w", "_at").alias("last_weight"))
    return summed.na.fill(0.0, list(INTEREST_FEATURES))


def train_interest_model(samples: DataFrame, **options) -> BoostedTrees:
    """Boosted trees on the training samples."""
    return train_gbt_depthwise(samples.filter(F.col("split") == "train"), INTEREST_FEATURES, **options)


def score_interest(model: BoostedTrees, samples: DataFrame, split: str = "test") -> DataFrame:
    keep = ("user_id", "item_id", "item_category", "cutoff_time", "label")
    return score(model, samples.filter(F.col("split") == split), keep)
