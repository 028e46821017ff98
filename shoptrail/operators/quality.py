"""Profiles and quality reports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K


def _as_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """One-row aggregate turned into (key, value) rows."""
    return df.unpivot([], df.columns, key, value)


def profile_shape(df: DataFrame) -> DataFrame:
    """(column, null_count), plus the number of rows under the name ``row_count``."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return _as_rows(df.agg(F.count("*").alias("row_count"), *counts), "column", "null_count")


def invalid_id_counts(events: DataFrame) -> DataFrame:
    """Ids at or below 0. The rows are counted, not removed."""
    return events.agg(*[
        F.count_if(F.col(c) <= 0).alias(f"invalid_{c}") for c in ("user_id", "item_id", "item_category")
    ])


def duplicate_count(events: DataFrame, keys: Sequence[str] = K.EVENT_KEY) -> DataFrame:
    groups = events.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def time_range(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count_if(F.col("time").isNull()).alias("invalid_time_count"),
        F.min("time").alias("min_time"), F.max("time").alias("max_time"),
    )


def invalid_behavior_count(events: DataFrame) -> DataFrame:
    code = F.col("behavior_type")
    return events.agg(F.count_if(code.isNull() | ~code.isin(*K.BEHAVIOURS)).alias("invalid_behavior_count"))


def quality_report(events: DataFrame) -> DataFrame:
    """(section, metric, value) of completeness, consistency, uniqueness and time validity.

    Everything but the duplicate count comes from one pass; duplicates need a shuffle of the
    distinct keys, whose counts are already combined map-side.
    """
    code = F.col("behavior_type")
    measures: dict[tuple[str, str], Column] = {
        ("completeness", c): F.count_if(F.col(c).isNull()).cast("string") for c in K.EVENT_COLUMNS
    }
    measures["consistency", "invalid_behavior_count"] = F.count_if(
        code.isNull() | ~code.isin(*K.BEHAVIOURS)).cast("string")
    measures["time", "invalid_time_count"] = F.count_if(F.col("time").isNull()).cast("string")
    measures["time", "min_time"] = F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss")
    measures["time", "max_time"] = F.date_format(F.max("time"), "yyyy-MM-dd HH:mm:ss")
    one_pass = _as_rows(
        events.agg(*[m.alias(f"{s}.{k}") for (s, k), m in measures.items()]).toDF(
            *[f"{s}__{k}" for s, k in measures]), "name", "value")
    parts = F.split("name", "__", 2)
    report = one_pass.select(parts[0].alias("section"), parts[1].alias("metric"), "value")
    unique = duplicate_count(events).select(
        F.lit("uniqueness").alias("section"), F.lit("duplicate_count").alias("metric"),
        F.col("duplicate_count").cast("string").alias("value"))
    return report.unionByName(unique)


def reconcile_mart(fact: DataFrame, mart: DataFrame, key: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Keys whose mart values differ from a fresh aggregate of the fact, or exist on one side only."""
    key = list(key)
    again = fact.groupBy(*key).agg(*[m.alias(f"_{c}") for c, m in measures.items()]).withColumnsRenamed(
        {k: f"_k_{k}" for k in key}).withColumn("_fact", F.lit(True))
    kept = mart.select(*key, *measures).withColumn("_mart", F.lit(True))
    same = None
    for k in key:
        clause = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = clause if same is None else same & clause
    both = kept.join(again, same, "full_outer")
    differs = F.col("_fact").isNull() | F.col("_mart").isNull()
    for c in measures:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return both.filter(differs).select(
        *[F.coalesce(k, f"_k_{k}").alias(k) for k in key],
        *[x for c in measures for x in (F.col(c).alias(f"mart_{c}"), F.col(f"_{c}").alias(f"fact_{c}"))],
    )


def missing_rate(df: DataFrame) -> DataFrame:
    """(column, missing_rate), highest first."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return _as_rows(rates, "column", "missing_rate").orderBy(F.desc("missing_rate"), "column")


def unique_count(df: DataFrame) -> DataFrame:
    """(column, unique_count), NULL counted as a value, lowest first."""
    counts = df.agg(*[
        (F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("bigint")), F.lit(0))).alias(c)
        for c in df.columns
    ])
    return _as_rows(counts, "column", "unique_count").orderBy("unique_count", "column")


def duplicate_users(df: DataFrame) -> DataFrame:
    per_user = df.groupBy("user_id").agg(F.count("*").alias("n"))
    return per_user.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_users"))


def duplicate_column_names(df: DataFrame) -> int:
    return sum(n - 1 for n in Counter(df.columns).values())


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with at most one value, NULL counted as a value: min and max tell, no distinct is needed."""
    checks = []
    for c in df.columns:
        col = F.col(c)
        one_value = F.count_if(col.isNull()) == 0
        one_value = one_value & F.min(col).eqNullSafe(F.max(col))
        checks.append((one_value | (F.count(col) == 0)).alias(c))
    row = df.agg(*checks).first()
    return [c for c in df.columns if row[c]]


def feature_quality_summary(wide: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row about the wide table before and after cleaning."""
    low = constant_columns(wide)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cleaned.columns), F.lit(0))
    after = cleaned.agg(F.count("*").alias("cleaned_rows"), nulls.cast("bigint").alias("nulls_left"))
    before = wide.agg(F.count("*").alias("wide_rows"))
    duplicates = duplicate_users(wide)
    return after.select(
        before.scalar().alias("wide_rows"), F.lit(len(wide.columns)).alias("wide_columns"),
        duplicates.scalar().alias("duplicate_users"),
        F.lit(duplicate_column_names(wide)).alias("duplicate_columns"),
        F.lit(len(low)).alias("low_variance_count"), F.lit(",".join(low)).alias("low_variance_features"),
        "cleaned_rows", F.lit(len(cleaned.columns)).alias("cleaned_columns"), "nulls_left",
    )
