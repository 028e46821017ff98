"""URL filters: rules first, then gradient-boosted trees on lexical features; DataFrame functions and Spark ML only.

A rule names a host and a path beginning; it fits its host and all subdomains where the url's path starts with the rule's, and
the longest rule wins. Urls without a rule are judged by trees trained from labelled urls: lengths, depth, share of digits and
hyphens, entropy of the host's letters, number of parameters, and statistics of the host's suffix over all labelled urls (their
number and smoothed share of bad ones; the overall share for a suffix without any). Only fitting the trees takes a bounded sample of
them (``LABELLED``).

Null urls and urls without ``://`` have an empty host and path, and are judged by the trees like any other. With no labels, or
labels of one class, the trees give way to that class (allow without labels). Repeated rows are judged alike. Other columns are
handed on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sampling import about

LABELLED = 20_000
BROADCAST_SUFFIXES = 1_000_000
# fixed values: words of hosts that count as bad when urls are labelled by a list
BAD_WORDS = "casino pills bets spam ads porn viagra lottery jackpot loans replica torrent".split()

FEATURES = ["url_length", "host_length", "path_length", "depth", "digits", "hyphens", "labels", "longest_label", "entropy", "parameters",
            "escapes", "suffix_rows", "suffix_bad"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null without one; ``rules`` are (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def listed_label(host: Column, words: Sequence[str] = BAD_WORDS) -> Column:
    """1 where a part of the host between dots and hyphens is a listed word, else 0."""
    parts = F.split(host, "[.-]")
    return F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])).cast("int")


def _entropy(text: Column) -> Column:
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    size = F.greatest(F.size(letters), F.lit(1))
    share = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda d: d == c)) / size)
    return F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def lexical(df: DataFrame, url: str) -> DataFrame:
    """``df`` with its host, path, suffix and lexical features."""
    text = F.coalesce(F.col(url), F.lit(""))
    named = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    count = lambda column, pattern: F.regexp_count(column, F.lit(pattern)).cast("double")
    size = F.greatest(F.length(text), F.lit(1))
    return named.withColumns({
        "suffix": suffix_of(host),
        "url_length": F.length(text).cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": count(path, "/[^/]+"), "digits": count(text, "[0-9]") / size, "hyphens": count(host, "-"), "labels": count(host, "[^.]+"),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))).cast("double"), "entropy": _entropy(host),
        "parameters": count(F.regexp_extract(text, r"(?s)\?([^#]*)", 1), "[^&]+"), "escapes": count(text, "%[0-9A-Fa-f]{2}"),
    })


@dataclass
class UrlModel:
    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    constant: str = "allow"
    share: float = 0.0


def train(labelled: DataFrame, url: str = "url", label: str = "label", trees: int = 10, depth: int = 4) -> UrlModel:
    """A model from (url, label), 1 for bad; other labels are left out."""
    known = labelled.filter(F.col(label).isin(0, 1)).select(F.col(url).alias("_url"), F.col(label).cast("double").alias("_label"))
    sample = materialize(lexical(about(known, "_url", LABELLED), "_url"))  # a bounded number of rows, read by the sums and the fit
    sums = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("_label"), F.lit(0.0)).alias("bad")).first()
    if not sums["bad"] or sums["bad"] == sums["n"]:
        return UrlModel(None, None, "block" if sums["bad"] else "allow")
    counts = materialize(known.groupBy(suffix_of(host_of(F.col("_url"))).alias("_suffix")).agg(
        F.count("*").alias("n"), F.sum("_label").alias("bad")))
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("suffixes")).first()
    share = total["bad"] / total["n"]
    suffixes = counts.select("_suffix", F.log1p("n").alias("suffix_rows"), ((F.col("bad") + 20 * share) / (F.col("n") + 20)).alias("suffix_bad"))
    if total["suffixes"] <= BROADCAST_SUFFIXES:  # some 50 bytes each
        suffixes = suffixes.hint("broadcast")
    model = UrlModel(None, suffixes, share=share)
    fitted = GBTClassifier(featuresCol="_vector", labelCol="_label", predictionCol="_bad",
                           maxIter=trees, maxDepth=depth, seed=7).fit(_without_own(sample, counts, share))
    model.trees = fitted
    return model


def _without_own(sample: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """The sample with the statistics of each row's suffix over all other labelled urls, so that no row tells its own label."""
    few = counts.hint("broadcast") if counts.count() <= BROADCAST_SUFFIXES else counts
    joined = sample.join(few, F.col("suffix") == F.col("_suffix"))
    others = joined.withColumns({
        "suffix_rows": F.log1p(F.col("n") - 1), "suffix_bad": (F.col("bad") - F.col("_label") + 20 * share) / (F.col("n") + 19)})
    return VectorAssembler(inputCols=FEATURES, outputCol="_vector").transform(others)


def _assembled(df: DataFrame, model: UrlModel) -> DataFrame:
    joined = df.join(model.suffixes, F.col("suffix") == F.col("_suffix"), "left").fillna({"suffix_rows": 0.0, "suffix_bad": model.share})
    return VectorAssembler(inputCols=FEATURES, outputCol="_vector").transform(joined)


def judge(df: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]], url: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, host, path, rule and verdict of each url; ``keep`` may hold columns of any other names."""
    if {"host", "path", "rule", "verdict"} & set(keep):
        raise ValueError("columns host, path, rule and verdict are made here")
    named = lexical(df.select(F.struct(*keep).alias("_keep") if keep else F.lit(0).alias("_keep"), F.col(url).alias("_url")), "_url")
    if model.trees is None:
        scored = named.withColumn("_judged", F.lit(model.constant))
    else:
        scored = model.trees.transform(_assembled(named, model)).withColumn("_judged", F.when(F.col("_bad") > 0, "block").otherwise("allow"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return scored.select(*[F.col("_keep")[c].alias(c) for c in keep], "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("_judged")).alias("verdict"))
