"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("behavior_type", T.ByteType()),
    T.StructField("item_category", T.IntegerType()),
    T.StructField("time", T.TimestampNTZType()),
])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, corrupt_column: str | None = None) -> DataFrame:
    """CSV with a header and a fixed schema (no inference pass); files are split across tasks.

    With ``corrupt_column`` the text of rows that do not parse is kept in that column.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def scan_csv_preview(spark: SparkSession, path: str, rows: int = 5, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The first rows of a CSV; the limit stops the scan early."""
    return scan_csv(spark, path, schema).limit(rows)


def scan_csv_parallel(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Same as ``scan_csv``: ``spark.sql.files.maxPartitionBytes`` sets the split size."""
    return scan_csv(spark, path, schema)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; the scan reads no others."""
    return read_table(spark, path).select(*columns)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Reader by suffix: ``.csv``, ``.parquet`` / ``.pq``, or a folder of parquet files."""
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)
    suffix = suffix[1].lower() if len(suffix) == 2 else "parquet"
    if suffix == "csv":
        if schema is not None:
            return scan_csv(spark, path, schema)
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if suffix in ("parquet", "pq"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported table format: {path}")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for reports of a few rows only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """Spark ML models by their own writer, boosted trees as parquet."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)


def publish_star_schema(tables: dict[str, DataFrame], path: str | None = None) -> None:
    """Register the star tables as views for SQL text; with ``path`` also write them there first."""
    for name, df in tables.items():
        if path:
            target = f"{path.rstrip('/')}/{name}"
            write_parquet(df, target)
            df = df.sparkSession.read.parquet(target)
        df.createOrReplaceTempView(name)


def query_sql(spark: SparkSession, sql: str) -> DataFrame:
    """SQL text over the published tables."""
    return spark.sql(sql)
