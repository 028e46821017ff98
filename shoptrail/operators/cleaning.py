"""Cleaning steps, each from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import clip, finite_or_null
from ..functions.ordering import column_medians
from .quality import constant_columns

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def dedup_events(events: DataFrame, keys: Sequence[str] = K.EVENT_KEY) -> DataFrame:
    """One row per (user, item, behaviour, time); the smallest of the other columns is kept.

    A ``min`` combines map-side, so copies of one event never travel.
    """
    rest = [c for c in events.columns if c not in keys]
    if not rest:
        return events.select(*keys).distinct()
    if len(rest) == 1:  # a plain minimum keeps the hash aggregate
        return events.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0])).select(*events.columns)
    first = events.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest"))
    return first.select(*[c if c in keys else F.col(f"_rest.{c}").alias(c) for c in events.columns])


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def parse_time(df: DataFrame, column: str = "time", strict: bool = False) -> DataFrame:
    """Text to timestamp. Strict parsing fails on bad text; lenient parsing drops the row."""
    if strict:
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df.withColumn(column, F.col(column).try_cast("timestamp_ntz")).filter(F.col(column).isNotNull())


def downcast(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "user_id": F.col("user_id").cast("int"),
        "item_id": F.col("item_id").cast("int"),
        "item_category": F.col("item_category").cast("int"),
        "behavior_type": F.col("behavior_type").cast("tinyint"),
    })


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def fill_missing(df: DataFrame, keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """Numbers become 0, text becomes ``unknown``; key columns stay as they are."""
    numbers = [c for c, t in df.dtypes if t in _NUMERIC and c not in keep]
    texts = [c for c, t in df.dtypes if t == "string" and c not in keep]
    if numbers:
        df = df.na.fill(0, subset=numbers)
    return df.na.fill("unknown", subset=texts) if texts else df


def replace_inf(df: DataFrame, columns: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Infinite values and NaN become NULL, then ``fill`` unless it is None."""
    def fixed(c):
        value = finite_or_null(F.col(c).cast("double"))
        return value if fill is None else F.coalesce(value, F.lit(float(fill)))

    return df.withColumns({c: fixed(c) for c in columns})


def train_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, median) of the training rows, exact."""
    return column_medians(replace_inf(train, columns, fill=None), columns)


def impute_train_median(frames: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """Medians of the first frame fill all frames. One number per column reaches the driver."""
    cleaned = [replace_inf(f, columns, fill=None) for f in frames]
    medians = {r["feature"]: r["median"] for r in train_medians(frames[0], columns).collect()}
    return [f.na.fill({c: medians.get(c, 0.0) for c in columns}) for f in cleaned]


def clip_columns(df: DataFrame, columns: Sequence[str], low: float, high: float) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), low, high) for c in columns})
