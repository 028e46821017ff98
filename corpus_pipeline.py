"""A training-data pipeline over ``documents``: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import bpe, jaccard, mixing, quality, substrings
from shoptrail.llm.queries import table, tokenizer_path
from shoptrail.session import discard, stored

NEAR_SHINGLE, NEAR_THRESHOLD = 5, 80  # op2_jaccard has a contract of its own: 4 words, 85


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays; sets of five words link from 0.8 on."""
    return jaccard.keep_one(docs, n=NEAR_SHINGLE, threshold=NEAR_THRESHOLD)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans go, but for the first; ``n_chars`` follows."""
    return substrings.dedup(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text."""
    encoded = bpe.encode(docs, tokenizer_path(), keep=[c for c in docs.columns if c not in ("text", "ids", "n_tokens")])
    return encoded.withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

ORACLE_SQL = None  # trained models, a Newton iteration and a tokenizer: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if written is not None:
            discard(written)  # the stage that read it is written
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
