"""Event tables made from the retail and event-stream tables.

``dense_events``: few users and items, times to the microsecond, some invalid ids and codes.
``sparse_events``: many users and items, day-level times, many ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dense_events(spark: SparkSession, folder: str) -> DataFrame:
    number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    kind = F.col("event_type")
    code = F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "signup", 3).when(kind == "purchase", 4)
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "user_id",
        number.alias("item_id"), (number % 10).alias("item_category"),
        code.otherwise(0).alias("behavior_type"), F.col("ts").alias("time"),
    )


def sparse_events(spark: SparkSession, folder: str) -> DataFrame:
    def table(name, *columns):
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    lines = table("lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table("orders", "o_orderkey", "o_custkey")
    parts = table("part", "p_partkey", "p_brand")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    code = (
        F.when((flag == "A") & (status == "F"), 4)
        .when((flag == "R") & (status == "F"), 3)
        .when((flag == "A") & (status == "O"), 2)
        .otherwise(1)
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
            F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("item_category"),
            code.alias("behavior_type"), F.col("l_shipdate").alias("time"),
        )
    )
