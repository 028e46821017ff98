"""Forest importances grown in tasks against trees of one row loop, and against Spark's own forests."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler

from shoptrail.operators import dataset, forest

FEATURES = ["a", "b", "c", "d", "e"]


def made(n, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c, d = rng.gauss(0, 1), rng.gauss(0, 1), rng.randint(0, 4), rng.random()
        rows.append((i, a, b, c, d, 1.0, int(a + 0.5 * b + 0.4 * (c == 2) + rng.gauss(0, 0.6) > 0.2)))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(made(1500), "user_id long, a double, b double, c int, d double, e double, label int").repartition(4).cache()


def plain(bins, label, times, number, level, tree, seed, count, depth):
    """(class or mixed, gains) by recursion over rows."""
    zero, one = (times * (label == 0)).sum(), (times * label).sum()
    leaf = int(one > zero), np.zeros(len(bins))
    if not zero or not one or level >= depth:
        return leaf
    best = (1e-12 * (zero + one), None, None)
    gini = lambda z, o: 2 * z * o / (z + o) if z + o else 0.0
    for f in forest.tried(np.array([number]), tree, seed, len(bins), count)[0]:
        for cut in range(1, int(bins[f].max())):
            left = bins[f] <= cut
            z, o = (times[left] * (label[left] == 0)).sum(), (times[left] * label[left]).sum()
            gain = gini(zero, one) - gini(z, o) - gini(zero - z, one - o)
            if z + o and z + o < zero + one and gain > best[0]:
                best = gain, f, cut
    if best[1] is None:
        return leaf
    left = bins[best[1]] <= best[2]
    (x, p), (y, q) = (plain(bins[:, s], label[s], times[s], 2 * number + k, level + 1, tree, seed, count, depth) for k, s in enumerate((left, ~left)))
    gains = p + q
    if x != y or x == forest.MIXED:
        gains[best[1]] += best[0]
        x = forest.MIXED
    return x, gains


@pytest.mark.parametrize("depth", [1, 4, 30])
def test_subtrees_equal_a_plain_recursion(depth):
    rng = np.random.default_rng(8)
    bins = rng.integers(1, 9, (6, 300)).astype(np.uint8)
    label = ((bins[0] > 4) ^ (bins[1] > 6) ^ (rng.random(300) < 0.15)).astype(np.int64)
    times = rng.poisson(1, 300)
    rows = times > 0
    for tree in range(3):
        want = plain(bins[:, rows], label[rows], times[rows], 1, 0, tree, 7, 3, depth)
        got = forest.subtree(np.ascontiguousarray(bins[:, rows]), label[rows], times[rows], 1, 0, tree, 7, 3, depth)
        assert got[0] == want[0] and np.allclose(got[1], want[1])


def test_passes_over_large_nodes_give_the_same_forest(table, monkeypatch):
    """However few rows a task may have, and with the same bins however the table is partitioned."""
    edges = forest.edges_of(table, FEATURES)
    monkeypatch.setattr(forest, "edges_of", lambda *_: edges)
    want = forest.importances(table, FEATURES, "label", 6, 30, 42)
    assert np.allclose(forest.importances(table.repartition(2), FEATURES, "label", 6, 30, 42, local_rows=100), want)
    assert math.isclose(sum(want), 1.0) and want[4] == 0.0


def test_importances_are_those_of_spark_forests(table):
    got = {r["feature"]: r["importance"] for r in dataset.feature_importance_rf(table, FEATURES).collect()}
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    model = RandomForestClassifier(numTrees=100, maxDepth=30, seed=42, labelCol="label").fit(vectors)
    assert np.allclose([got[f] for f in FEATURES], model.featureImportances.toArray(), atol=0.02)


def test_trees_do_not_grow_on_the_driver(table, monkeypatch):
    """Of trees of any depth the driver holds upper nodes only: none where a task may have all rows."""
    held, plain_ = [], forest.Upper.gains

    def counted(upper, features, below):
        held.append(len(upper.tree.feature))
        return plain_(upper, features, below)

    monkeypatch.setattr(forest.Upper, "gains", counted)
    forest.importances(table, FEATURES, "label", 3, 30, 42)
    assert held == [1, 1, 1]


def test_unknown_values_are_refused(spark):
    schema = "a double, b double, label int"
    for bad in ([], [(1.0, None, 1)], [(float("nan"), 1.0, 0)], [(1.0, 2.0, None)], [(1.0, 2.0, 3)]):
        with pytest.raises(ValueError):
            dataset.feature_importance_rf(spark.createDataFrame(bad, schema), ["a", "b"], trees=2)


def test_top_features_are_those_of_the_forest(table):
    want = sorted(zip(forest.importances(table, FEATURES, "label", 8, 30, 42), FEATURES), key=lambda r: (-r[0], r[1]))
    importance = dataset.feature_importance_rf(table, FEATURES, trees=8)
    assert [r["feature"] for r in importance.collect()] == [f for _, f in want]
    kept = dataset.select_top_features(table, importance, 2)
    assert kept.columns == ["user_id", "label", *[f for _, f in want[:2]]] and kept.count() == table.count()
