"""Boosted trees on distributed histograms against a plain computation over all rows."""

import heapq
import random

import numpy as np
import pytest

from shoptrail.operators import boosting, classifiers, metrics, tuning
from shoptrail.operators.boosting import Settings
from shoptrail.sources import tables

FEATURES = ["a", "b", "c", "flag"]


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.randint(0, 4)
        label = int(a * b + 0.5 * (c == 2) + rng.gauss(0, 0.7) > 0.2)
        rows.append((i, None if i % 13 == 0 else a, float("nan") if i % 17 == 0 else b, c, i % 2 == 0, label))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    schema = "user_id long, a double, b double, c int, flag boolean, label int"
    df = spark.createDataFrame(made(900), schema)
    return df.withColumn("flag", df.flag.cast("int")).repartition(5).cache()


def value_of(rows, edges):
    columns = [np.array([np.nan if r[i] is None else float(r[i]) for r in rows]) for i in range(1, 5)]
    return boosting.binned(columns, edges)


def best_of(bins, g, h, rows, s):
    """(gain, feature, cut, missing left) over all cuts, row by row sums."""
    def q(g, h):
        return max(abs(g) - s.reg_alpha, 0) ** 2 / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0

    found = None
    for side in (True, False):
        for f in range(bins.shape[0]):
            for cut in range(1, boosting.BINS - 1):
                left = rows[(bins[f, rows] <= cut) & ((bins[f, rows] > 0) | side)]
                right = np.setdiff1d(rows, left)
                if min(len(left), len(right)) < max(1, s.min_child_samples) or min(h[left].sum(), h[right].sum()) < s.min_child_weight:
                    continue
                gain = q(g[left].sum(), h[left].sum()) + q(g[right].sum(), h[right].sum()) - q(g[rows].sum(), h[rows].sum())
                if gain > max(s.gamma, 1e-6) and (found is None or gain > found[0] + 1e-9):
                    found = (gain, left, right)
    return found


def plain_tree(bins, g, h, s):
    """Rows and weight of every leaf, grown best first one split at a time."""
    everything = np.arange(bins.shape[1])
    heap, leaves, count = [], [], 0

    def offer(rows, depth):
        nonlocal count
        found = None if 0 < s.max_depth <= depth else best_of(bins, g, h, rows, s)
        if found:
            count += 1
            heapq.heappush(heap, (-found[0], count, rows, found[1], found[2], depth))
        else:
            leaves.append(rows)

    offer(everything, 0)
    while heap and (s.num_leaves <= 0 or len(heap) + len(leaves) < s.num_leaves):
        _, _, _, left, right, depth = heapq.heappop(heap)
        offer(left, depth + 1)
        offer(right, depth + 1)
    leaves += [x[2] for x in heap]
    value = np.zeros(bins.shape[1])
    for rows in leaves:
        total, below = g[rows].sum(), h[rows].sum() + s.reg_lambda
        value[rows] = -np.sign(total) * max(abs(total) - s.reg_alpha, 0) / below * s.learning_rate
    return value, len(leaves)


@pytest.mark.parametrize("settings", [
    Settings(3, 0.3, max_depth=3, reg_alpha=0.5, reg_lambda=1.5, gamma=0.2, min_child_weight=2.0, scale_pos_weight=1.4),
    Settings(3, 0.3, num_leaves=7, min_child_samples=8, reg_lambda=0.1),
    Settings(2, 0.5, num_leaves=12, max_depth=4, gamma=1.0),
])
def test_trees_equal_a_plain_computation(spark, table, settings):
    rows = made(900)[:200]
    df = table.filter("user_id < 200")
    model = boosting.fit(df, FEATURES, "label", settings)
    bins, label = value_of(rows, model.edges), np.array([r[5] for r in rows], float)
    margin = np.full(len(rows), np.log(label.sum() * settings.scale_pos_weight / (len(rows) - label.sum())))
    for tree in model.trees:
        p, w = 1 / (1 + np.exp(-margin)), np.where(label == 1, settings.scale_pos_weight, 1.0)
        value, leaves = plain_tree(bins, (p - label) * w, p * (1 - p) * w, settings)
        assert np.allclose(tree.apply(bins), value, atol=1e-4)
        assert tree.leaves() == leaves
        assert settings.num_leaves <= 0 or leaves <= settings.num_leaves
        margin = margin + value
    scored = {r["user_id"]: r["probability"] for r in classifiers.score(model, df).collect()}
    assert np.allclose([scored[r[0]] for r in rows], 1 / (1 + np.exp(-margin)), atol=1e-4)


def test_leaves_are_limited_at_any_depth(table):
    model = classifiers.train_gbt_leaf_limited(table, FEATURES, n_estimators=4, num_leaves=9, min_child_samples=3)
    assert all(t.leaves() <= 9 for t in model.trees) and max(t.leaves() for t in model.trees) == 9
    assert any(depth(t) > 4 for t in model.trees)  # a depth bound for nine leaves would be four
    assert metrics.roc_auc(classifiers.score(model, table)) > 0.8


def depth(tree, node=0):
    return 0 if tree.feature[node] < 0 else 1 + max(depth(tree, tree.left[node]), depth(tree, tree.right[node]))


def test_partitions_do_not_matter_and_files_keep_the_model(spark, table, tmp_path):
    options = {"n_estimators": 12, "max_depth": 3}  # more trees than passes apply on top of stored margins
    first = classifiers.train_gbt_depthwise(table, FEATURES, **options)
    again = classifiers.train_gbt_depthwise(table.repartition(3), FEATURES, **options)
    if again.edges == first.edges:  # Spark's quantiles may differ within their error
        assert first.to_dict()["trees"] == again.to_dict()["trees"]
    tables.save_model(first, str(tmp_path / "trees"))
    loaded = tables.load_model(str(tmp_path / "trees"), boosting.BoostedTrees)
    assert loaded.to_dict() == first.to_dict()
    history = [r["loss"] for r in classifiers.training_history(first, table).collect()]
    assert len(history) == 12 and history[-1] < history[0]
    assert sum(first.importances()) == pytest.approx(1.0)


def test_models_grow_side_by_side_as_alone(table):
    settings = [Settings(6, 0.2, max_depth=2, subsample=0.7), Settings(4, 0.1, num_leaves=5, colsample=0.6, scale_pos_weight=2.0)]
    booster = boosting.Booster(table, FEATURES, "label", settings)
    booster.grow({0: 3, 1: 4})
    booster.grow({0: 6})
    for i, s in enumerate(settings):
        assert booster.model(i).to_dict() == boosting.fit(table, FEATURES, "label", s).to_dict()
    booster.close()


def test_search_by_halving(table):
    train, valid = table.filter("user_id % 3 > 0"), table.filter("user_id % 3 = 0")
    found = tuning.tune_leaf_limited(train, valid, FEATURES, trials=9, narrow={"n_estimators": ("int", 6, 12)})
    trials = {r["trial"]: r for r in found.trials.collect()}
    assert len(trials) == 9
    whole = [t for t in trials.values() if t["rounds"] == len(found.best_model.trees) or t["rounds"] >= 6]
    best = max(whole, key=lambda t: t["auc"])
    assert metrics.roc_auc(classifiers.score(found.best_model, valid)) == pytest.approx(best["auc"])
    assert len(found.best_model.trees) == found.best_params["n_estimators"]
    alone = boosting.fit(train, FEATURES, "label", found.best_model.settings)
    assert alone.to_dict() == found.best_model.to_dict()  # growing further is training from the start


def test_one_class_is_refused(table):
    with pytest.raises(ValueError):
        classifiers.train_gbt_depthwise(table.filter("label = 1"), FEATURES)
    with pytest.raises(ValueError):
        classifiers.train_gbt_leaf_limited(table.limit(0), FEATURES, scale_pos_weight=1.0)


def test_rows_are_routed_as_one_by_one():
    rng = np.random.default_rng(3)
    tree, open_ = boosting.Tree(), [0]
    tree.add(0.0)
    while len(tree.feature) < 41:
        node = open_.pop(int(rng.integers(len(open_))))
        tree.feature[node], tree.cut[node], tree.missing_left[node] = int(rng.integers(3)), int(rng.integers(1, 9)), bool(rng.integers(2))
        tree.left[node], tree.right[node] = tree.add(float(rng.normal())), tree.add(float(rng.normal()))
        open_ += [tree.left[node], tree.right[node]]
    bins = rng.integers(0, 9, (3, 500)).astype(np.uint8)

    def leaf(row):
        node = 0
        while tree.feature[node] >= 0:
            value = bins[tree.feature[node], row]
            left = tree.missing_left[node] if value == 0 else value <= tree.cut[node]
            node = tree.left[node] if left else tree.right[node]
        return node

    some = np.array([0, 7, 7, 499])
    assert tree.route(bins).tolist() == [leaf(r) for r in range(500)]
    assert tree.route(bins, some).tolist() == [leaf(r) for r in some]
    assert tree.apply(bins, some[:0]).tolist() == []


def test_passes_move_rows_only_through_the_trees_they_need(table, monkeypatch):
    """Trees that are not folded yet are applied to the rows of the asked nodes, not to all rows."""
    routed, plain = [], boosting.Tree.apply

    def counted(tree, bins, rows=None):
        routed.append((bins.shape[1], bins.shape[1] if rows is None else len(rows)))
        return plain(tree, bins, rows)

    booster = boosting.Booster(table, FEATURES, "label", [Settings(n_estimators=3, max_depth=4, subsample=0.5)])
    booster.grow({0: 2})
    block = booster.state.first()
    monkeypatch.setattr(boosting.Tree, "apply", counted)
    grower = boosting.Grower(booster.settings[0], np.arange(len(FEATURES)))
    sums = booster._sums({0: (grower, grower.wanted())})
    list(sums(iter([block])))
    booster.close()
    assert routed and all(0 < used < 0.8 * all_ for all_, used in routed)


def test_models_that_were_not_kept_leave_the_blocks(table):
    booster = boosting.Booster(table, FEATURES, "label", [Settings(max_depth=2), Settings(max_depth=3)])
    booster.grow({0: 1, 1: 1})
    booster.keep([1])
    booster.grow({1: boosting.FOLD + 1})
    assert all(set(block[3]) == {1} for block in booster.state.collect())
    alone = boosting.fit(table, FEATURES, "label", Settings(n_estimators=boosting.FOLD + 1, max_depth=3))
    assert booster.model(1).trees == alone.trees
    with pytest.raises(ValueError):
        booster.grow({0: 2})
    booster.close()


def test_sums_on_the_driver_are_bounded(table, monkeypatch):
    """The same trees where a pass brings the sums of one node and no grower keeps any."""
    settings = [Settings(n_estimators=2, max_depth=5), Settings(n_estimators=2, num_leaves=9, min_child_samples=3, colsample=0.6)]
    want = [boosting.fit(table, FEATURES, "label", s).trees for s in settings]
    passes, plain, held = [], boosting.Booster._pass, []

    def counted(booster, work):
        passes.append(sum(booster._bytes(*w) for w in work.values()))
        held.append(sum(values.nbytes for grower, _ in work.values() for values in grower.sums.values()))
        return plain(booster, work)

    monkeypatch.setattr(boosting, "PASS_BYTES", 1000)
    monkeypatch.setattr(boosting, "HELD_BYTES", 15_000)
    monkeypatch.setattr(boosting.Booster, "_pass", counted)
    booster = boosting.Booster(table, FEATURES, "label", settings)
    booster.grow({0: 2, 1: 2})
    booster.close()
    assert [booster.model(i).trees for i in range(2)] == want
    assert max(passes) <= len(FEATURES) * 3 * boosting.BINS * 8 and 0 < max(held) <= 15_000


def test_a_split_keeps_six_numbers_and_not_the_sums():
    sums = np.random.default_rng(4).integers(1, 1 << 22, (3, 5, boosting.BINS))
    sums[0] -= 1 << 21
    split = boosting.best_split(sums, Settings(reg_lambda=1.0))
    assert split.left.base is None and split.right.base is None
