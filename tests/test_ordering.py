"""Ranks, quantiles and draws against pandas, numpy and hashlib."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptrail.functions import draws, ordering
from shoptrail.operators.experiment import with_score_bins


@pytest.fixture(scope="module")
def numbers(spark):
    """Most values are equal; the key is unique."""
    rng = np.random.default_rng(3)
    value = np.where(rng.random(500) < 0.6, 7.0, rng.integers(0, 30, 500).astype(float))
    frame = pd.DataFrame({"id": rng.permutation(500), "g": rng.integers(0, 3, 500), "v": value})
    return frame, spark.createDataFrame(frame).repartition(5)


def test_global_rank(numbers):
    frame, df = numbers
    want = frame.sort_values(["v", "id"]).reset_index(drop=True)
    got = {r["id"]: r["rank"] for r in ordering.global_rank(df, ["v", "id"]).collect()}
    assert got == {row.id: i + 1 for i, row in want.iterrows()}


def test_grouped_rank(numbers):
    frame, df = numbers
    got = {r["id"]: r["rank"] for r in ordering.global_rank(df, ["v", "id"], ["g"]).collect()}
    ordered = frame.sort_values(["g", "v", "id"])
    want = dict(zip(ordered["id"], ordered.groupby("g").cumcount() + 1))
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 11, 29, 100, 499])
@pytest.mark.parametrize("q", [4, 5])
def test_qcut_codes(spark, n, q):
    want = pd.qcut(pd.Series(range(1, n + 1)).rank(method="first"), q=q, labels=False, duplicates="drop") if n > 1 else [None]
    got = spark.range(1, n + 1).select("id", ordering.qcut_codes(F.col("id"), n, q).alias("c")).orderBy("id").collect()
    assert [r["c"] for r in got] == [None if w is None or pd.isna(w) else int(w) for w in want]


def test_quantiles(numbers):
    frame, df = numbers
    probabilities = {"a": 0.0, "b": 0.2, "c": 0.5, "d": 0.83, "e": 1.0}
    row = ordering.exact_quantiles(df, "v", probabilities).first()
    for name, p in probabilities.items():
        assert row[name] == pytest.approx(frame["v"].quantile(p))
    for r in ordering.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect():
        assert r["m"] == pytest.approx(frame[frame["g"] == r["g"]]["v"].median())


def test_percent_rank(numbers):
    frame, df = numbers
    got = {r["id"]: r["p"] for r in ordering.percent_rank_avg(df, {"v": "p"}, "id").collect()}
    want = frame.set_index("id")["v"].rank(pct=True)
    assert all(got[i] == pytest.approx(want[i]) for i in got)


@pytest.mark.parametrize("bins", [2, 5, 10])
def test_score_bins(numbers, bins):
    frame, df = numbers
    got = {r["id"]: r["code"] for r in with_score_bins(df, bins, "code", "v").collect()}
    want = dict(zip(frame["id"], pd.qcut(frame["v"], bins, labels=False, duplicates="drop")))
    assert got == want


def test_sample_exact(numbers):
    frame, df = numbers
    digest = lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest()
    want = set(sorted(frame["id"], key=digest)[:123])
    assert {r["id"] for r in draws.sample_exact(df, 123, ["id"]).collect()} == want
    assert draws.sample_exact(df, 10_000, ["id"]).count() == 500
    assert draws.sample_exact(df, 0, ["id"]).count() == 0
    assert draws.sample_cap(df, 0, ["id"]).count() == 500


def test_draw_does_not_depend_on_layout(numbers):
    _, df = numbers
    one = {r["id"] for r in draws.sample_exact(df.repartition(1), 50, ["id"]).collect()}
    many = {r["id"] for r in draws.sample_exact(df.repartition(9, "v"), 50, ["id"]).collect()}
    assert one == many


def test_draws_on_repeated_keys_and_null_groups(spark):
    rows = [(i % 4, i, None if i % 5 == 0 else i % 2) for i in range(100)] + [(1, 1, 1)] * 30
    df = spark.createDataFrame(rows, "id long, v long, g long")
    assert draws.sample_exact(df, 37, ["id"]).count() == 37
    assert draws.sample_exact(df, 37, ["id"]).exceptAll(draws.sample_exact(df.repartition(5), 37, ["id"])).count() == 0
    quotas = df.groupBy("g").count().select("g", F.lit(7).cast("bigint").alias("quota"))
    drawn = draws.take_by_hash(df, ["id"], quotas, ["g"])
    assert {r["g"]: r["count"] for r in drawn.groupBy("g").count().collect()} == {None: 7, 0: 7, 1: 7}


def test_prefixes_grow_until_the_slot_is_small(spark, monkeypatch):
    df = spark.range(2000).withColumn("v", F.lit(1))
    want = {r["id"] for r in draws.sample_exact(df, 333, ["id"]).collect()}
    monkeypatch.setattr(draws, "_SLOT_ROWS", 0)
    assert {r["id"] for r in draws.sample_exact(df, 333, ["id"]).collect()} == want


def test_null_groups_stay(spark):
    from shoptrail.operators.dataset import class_weights, stratified_split, undersample_balanced
    from shoptrail.operators.metrics import evaluate_binary

    rows = [(i, None if i % 10 == 0 else i % 2, None if i % 3 == 0 else "g", i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "user_id long, label int, g string, probability double")
    known = df.filter("label is not null")
    counts = evaluate_binary(known, by=["g"]).collect()
    assert sum(r["sample_count"] for r in counts) == known.count() and len(counts) == 2
    assert stratified_split(df).count() == 100
    balanced = {r["label"]: r["count"] for r in undersample_balanced(df).groupBy("label").count().collect()}
    assert balanced == {0: 40, 1: 40}
    assert {r["class"] for r in class_weights(df).collect()} == {0, 1}
