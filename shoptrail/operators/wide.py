"""The wide user feature table and its cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .cleaning import drop_constant_columns, fill_missing
from .joins import left_join_user


def feature_table(time: DataFrame, sequence: DataFrame, business: DataFrame, svd: DataFrame | None = None) -> DataFrame:
    """Time features with sequence, business and factor features of the same user."""
    others = [sequence, business] + ([svd] if svd is not None else [])
    return left_join_user(time, *others)


def feature_table_cleaned(wide: DataFrame) -> DataFrame:
    """Without constant columns; missing numbers are 0 and missing text is ``unknown``."""
    return fill_missing(drop_constant_columns(wide))
