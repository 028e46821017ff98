"""Input contracts. Column checks read the schema only; value checks are one aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def require_non_empty(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def require_same_features(*frames: DataFrame) -> None:
    first = frames[0].columns
    for other in frames[1:]:
        if other.columns != first:
            raise ValueError(f"feature columns differ: {first} and {other.columns}")


def require_domain(
    df: DataFrame, labels: Sequence[str] = (), unit_interval: Sequence[str] = (), min_rows: int = 0
) -> DataFrame:
    """Label columns hold only 0 and 1, metric columns lie in [0, 1], enough rows exist."""
    checks = [F.count("*").alias("_rows")]
    checks += [F.count_if(~F.col(c).isin(0, 1)).alias(c) for c in labels]
    checks += [F.count_if(~F.col(c).between(0, 1)).alias(c) for c in unit_interval]
    row = df.agg(*checks).first().asDict()
    if row.pop("_rows") < min_rows:
        raise ValueError(f"fewer than {min_rows} rows")
    bad = sorted(c for c, n in row.items() if n)
    if bad:
        raise ValueError("values out of range in: " + ", ".join(bad))
    return df


def resolve_column(columns: Sequence[str], aliases: Sequence[str], required: bool = True) -> str | None:
    """First alias that names a column, ignoring case and the difference of space, dash, underscore."""
    def folded(name: str) -> str:
        return name.strip().lower().replace(" ", "_").replace("-", "_")

    known = {folded(c): c for c in reversed(list(columns))}
    for alias in aliases:
        if folded(alias) in known:
            return known[folded(alias)]
    if required:
        raise ValueError(f"none of {list(aliases)} among {list(columns)}")
    return None
