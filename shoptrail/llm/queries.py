"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, divergence, fingerprints, jaccard, langid, mixing, neighbours, quality, queries_sql, substrings, suffixes, toxicity, urls
from .sampling import remainder


BATCH_ROWS = 2_000  # of an Arrow batch: texts are long, and Spark's default of 10,000 rows fills executors


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents"), tokenizer_path(), keep=["doc_id"])
    decoded = bpe.decode(encoded, tokenizer_path(), text="decoded")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(table(spark, folder, "documents"))


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.dedup(documents, counts=("n_sentences", "n_removed"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op4_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = urls.train(pages.select("url", urls.listed_label(urls.host_of(F.col("url"))).alias("label")))
    return urls.judge(pages, model, URL_RULES, keep=["page_id"])


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality.learn(documents, table(spark, folder, "labels"))
    scored = quality.score(documents, model, keep=["doc_id"])
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= quality.THRESHOLD).alias("kept"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = table(spark, folder, "documents"), remainder("doc_id", 5) == 0
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(remainder("doc_id", 5) != 0)
    grammar = toxicity.learn(documents.select("doc_id", "text").join(labels, "doc_id"))
    scored = toxicity.score(documents, grammar, keep=["doc_id"])
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    made = fingerprints.edited(table(spark, folder, "documents"))
    own, changed, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    near = made.withColumns({"near_edited": fingerprints.likeness(own, changed), "near_next": fingerprints.likeness(own, following)})
    return near.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprints.written(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.written(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sized = documents.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    documents, part = table(spark, folder, "documents"), remainder("doc_id", 4)
    net = langid.train(documents.filter(part != 2))
    predicted = langid.predict(documents, net, keep=["doc_id"])
    return predicted.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.damage_report(table(spark, folder, "conversations"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    removed = suffixes.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# ---- the exact parts of operators whose whole result SQL can't state


def shingle_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The sizes of the sets that ``op2_jaccard`` joins."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"), F.lit(0).cast("bigint").alias("_row"))
    return jaccard.set_table(documents, "bigint").select(F.col("_key").alias("doc_id"), "n_shingles")


def url_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path and rule as ``op4_urls`` reads them."""
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    named = table(spark, folder, "pages").select("page_id", host.alias("host"), path.alias("path"))
    return named.withColumn("rule", urls.matched_rule(F.col("host"), F.col("path"), URL_RULES)[0])


def edited_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The texts that ``op8_fingerprints`` compares."""
    made = fingerprints.edited(table(spark, folder, "documents"))
    return made.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"))


def mixing_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes and targets that ``op9_mixing`` meets."""
    sized = table(spark, folder, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    goals = mixing.targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")))
    goals = goals.select(F.col("source").alias("_source"), "source_size", F.round("target", 3).alias("target"))
    return sized.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "size", "source_size", "target")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_substrings": op3_substrings,
    "op4_urls": op4_urls,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_fingerprints": op8_fingerprints,
    "op9_mixing": op9_mixing,
    "op10_langid": op10_langid,
    "op11_conversations": op11_conversations,
    "op12_divergence": op12_divergence,
    "op13_suffixes": op13_suffixes,
    "shingle_counts": shingle_counts,
    "url_parts": url_parts,
    "edited_texts": edited_texts,
    "mixing_targets": mixing_targets,
}

ORACLES: dict[str, str] = {
    "op11_conversations": queries_sql.OP11,
    "op12_divergence": queries_sql.OP12,
    "op13_suffixes": queries_sql.OP13,
    "shingle_counts": queries_sql.SHINGLE_COUNTS,
    "url_parts": queries_sql.url_parts(URL_RULES),
    "edited_texts": queries_sql.EDITED_TEXTS,
    "mixing_targets": queries_sql.MIXING_TARGETS,
}
