"""Column expressions over the event table. All of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K


def weights_map(weights: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])


def weight_of(behavior: Column, weights: dict) -> Column:
    """Weight of a behaviour code; NULL for codes without one."""
    return F.try_element_at(weights_map(weights), behavior.cast("int"))


def is_behavior(code: int) -> Column:
    return (F.col("behavior_type") == code).cast("int")


def time_period(hour: Column) -> Column:
    return (
        F.when((hour >= 0) & (hour < 6), K.NIGHT)
        .when((hour >= 6) & (hour < 12), K.MORNING)
        .when((hour >= 12) & (hour < 18), K.AFTERNOON)
        .otherwise(K.EVENING)
    )


def is_night(hour: Column) -> Column:
    return ((hour >= 18) | (hour < 6)).cast("int")


def active_level(count: Column) -> Column:
    """Level of a recent event count; NULL when there is no count."""
    return F.when(count >= 100, K.LEVEL_HIGH).when(count >= 30, K.LEVEL_MID).when(count.isNotNull(), K.LEVEL_LOW)


def activity_group(count: Column) -> Column:
    return F.when(count < 10, K.GROUP_LOW).when(count <= 50, K.GROUP_MID).otherwise(K.GROUP_HIGH)


def day_type(time: Column) -> Column:
    return F.when(F.weekday(time) >= 5, "Weekend").otherwise("Weekday")


def week_label_period(time: Column) -> Column:
    """``Monday/Sunday`` dates of the week."""
    day = F.to_date(time)
    monday = F.date_sub(day, F.weekday(day))
    return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))


def week_label_yw(time: Column) -> Column:
    """``%Y-%W``: weeks start on Monday, days before the first Monday are week 00."""
    day = F.to_date(time)
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")
    return F.concat_ws("-", F.date_format(day, "yyyy"), F.lpad(week.cast("string"), 2, "0"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """0 when the divisor is 0 or either side is NULL."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def finite_or_null(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def normalize_text_key(text: Column) -> Column:
    return F.translate(F.lower(F.trim(text)), " -", "__")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def start_of(day: Column) -> Column:
    """Midnight of a date, so that a date bound becomes a bound on ``time`` a scan can use."""
    return day.cast("timestamp_ntz")


def with_time_parts(events: DataFrame) -> DataFrame:
    time = F.col("time")
    return events.withColumns({
        "date": F.to_date(time),
        "hour": F.hour(time),
        "weekday": F.weekday(time),
        "month": F.month(time),
    })


def with_behavior_flags(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "is_browse": is_behavior(K.BROWSE),
        "is_fav": is_behavior(K.FAVOURITE),
        "is_cart": is_behavior(K.CART),
        "is_buy": is_behavior(K.BUY),
    })


def with_time_period(events: DataFrame) -> DataFrame:
    return events.withColumn("time_period", time_period(F.hour("time")))


def with_is_night(events: DataFrame) -> DataFrame:
    return events.withColumn("is_night", is_night(F.hour("time")))


def with_day_type(events: DataFrame) -> DataFrame:
    return events.withColumn("day_type", day_type(F.col("time")))


def with_implicit_weight(events: DataFrame) -> DataFrame:
    """Adds ``behavior_score``; events with an unknown code are left out."""
    scored = events.withColumn("behavior_score", weight_of(F.col("behavior_type"), K.IMPLICIT_WEIGHTS))
    return scored.filter(F.col("behavior_score").isNotNull())


def with_value_weight(events: DataFrame) -> DataFrame:
    return events.withColumn("behavior_score", weight_of(F.col("behavior_type"), K.VALUE_WEIGHTS))


def last_day(events: DataFrame) -> Column:
    """Last calendar day of the events as a scalar subquery: evaluated once, never joined."""
    return F.to_date(events.select(F.max("time")).scalar())


def recent_events(events: DataFrame, days: int) -> DataFrame:
    """Events on or after ``last day - days``."""
    return events.filter(F.col("time") >= start_of(F.date_sub(last_day(events), days)))


def events_between(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """Events with ``start <= time < end``; the bounds are dates or timestamps."""
    return events.filter((F.col("time") >= start_of(start)) & (F.col("time") < start_of(end)))


def events_up_to(events: DataFrame, day: Column) -> DataFrame:
    """Events on or before a day: the ``as of`` cut that keeps label days out of features."""
    return events.filter(F.col("time") < start_of(F.date_add(day, 1)))


def drop_columns_by_pattern(df: DataFrame, patterns=("label", "target", "prediction", "probability", "split", "time", "date")) -> list[str]:
    """Numeric column names whose name holds none of the patterns."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [
        name for name, dtype in df.dtypes
        if (dtype in numeric or dtype.startswith("decimal")) and not any(p in name.lower() for p in patterns)
    ]


def round_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded ratio; 0 where it is undefined."""
    return F.coalesce(F.round(ratio_or_null(numerator, denominator), digits), F.lit(0.0))


def cut_fixed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge at or above the value; the last label above all edges; NULL counts as above."""
    level = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        level = F.when(value <= edge, label).otherwise(level)
    return level
