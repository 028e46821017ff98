"""Models learn a planted signal; metrics equal Spark's evaluator; factors equal numpy's."""

import glob
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail import session
from shoptrail.operators import classifiers, experiment, explain, interaction, metrics, stacking, tuning


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, x, noise, int(x + 0.5 * rng.gauss(0, 1) > 0.3)))
    return spark.createDataFrame(rows, "user_id long, x double, noise double, label int").cache()


def test_auc_equals_evaluator(planted):
    scored = planted.select("label", F.round(1 / (1 + F.exp(-F.col("x"))), 1).alias("probability"))  # many ties
    ours = metrics.evaluate_binary(scored).first()
    assert ours.auc == pytest.approx(metrics.roc_auc(scored))
    cells = {r.label: (r.predicted_0, r.predicted_1) for r in metrics.confusion_matrix(scored).collect()}
    assert ours.accuracy == pytest.approx((cells[0][0] + cells[1][1]) / 400)


def test_one_class_has_no_auc(planted):
    one = planted.filter("label = 1").withColumn("probability", F.lit(0.2))
    row = metrics.evaluate_binary(one).first()
    assert math.isnan(row.auc) and row.precision == 0 and row.f1 == 0


def test_learners_find_the_signal(planted):
    for fit, options in ((classifiers.train_logistic, {}), (classifiers.train_gbt_depthwise, {"n_estimators": 5}),
                         (classifiers.train_gbt_leaf_limited, {"n_estimators": 5})):
        model = fit(planted, ["x", "noise"], **options)
        assert metrics.roc_auc(classifiers.score(model, planted)) > 0.85
    with pytest.raises(ValueError):
        classifiers.train_logistic(planted.filter("label = 1"), ["x"])


def test_search_is_repeatable(planted):
    first = tuning.tune_logistic(planted, planted, ["x", "noise"], trials=3)
    second = tuning.tune_logistic(planted, planted, ["x", "noise"], trials=3)
    assert first.best_params == second.best_params
    assert first.trials.count() == 3 and 1e-4 <= first.best_params["C"] <= 100


def test_permutation_importance(planted):
    model = classifiers.train_gbt_depthwise(planted, ["x", "noise"], n_estimators=5)
    rows = explain.tree_model_importance(model, planted, ["x", "noise"]).collect()
    assert rows[0].feature == "x" and rows[0].importance > 0.2


def test_stacking(spark, planted):
    base = 1 / (1 + F.exp(-F.col("x")))
    merged = planted.select("user_id", "label", base.alias("logistic_prob"), F.lit(0.5).alias("xgboost_prob"),
                            (1 / (1 + F.exp(-F.col("noise")))).alias("din_prob"))
    stack = stacking.stack_models(merged)
    assert stack.train.count() == 280 and stack.test.count() == 120
    weights = explain.stacking_weights(stack.model, spark).collect()
    assert weights[0].base_model == "Logistic Regression"


def test_factors_equal_numpy(spark, skewed):
    found = interaction.factorize(skewed, k_max=4)
    cells = interaction.interaction_matrix(skewed).collect()
    users = sorted({c.user_id for c in cells})
    items = sorted({c.item_id for c in cells})
    dense = np.zeros((len(users), len(items)))
    for c in cells:
        dense[users.index(c.user_id), items.index(c.item_id)] = c.weight
    _, s, vt = np.linalg.svd(dense)
    assert np.allclose(found.singular_values, s[:4], rtol=1e-3)
    got = {r[0]: np.array(r[1:]) for r in found.users.collect()}
    matrix = np.array([got[u] for u in users])
    assert np.allclose(np.abs(matrix[:, :2]), np.abs(dense @ vt[:2].T), atol=0.05)
    assert 0 < found.explained_variance_ratio <= 1


def test_products_by_blocks(skewed):
    """Small blocks, with users and items of more cells than a block."""
    cells = interaction.interaction_matrix(skewed)
    known = {(c.user_id, c.item_id): c.weight for c in cells.collect()}
    vectors = {i: (float(i), 1.0) for _, i in known if i != 7}  # one is missing
    table = skewed.sparkSession.createDataFrame([(i, *v) for i, v in vectors.items()], "item_id long, a double, b double")
    for size, whole in ((50, False), (1 << 18, True)):
        layout = interaction.lay_out(cells, "item_id", "user_id", size)
        assert layout.whole == whole and (layout.blocks.count() > 10 or whole)
        got = {r.user_id: (r.a, r.b) for r in interaction.multiply(layout, table, ["a", "b"]).collect()}
        want = {}
        for (u, i), w in known.items():
            v = vectors.get(i, (0.0, 0.0))
            want[u] = tuple(x + w * y for x, y in zip(want.get(u, (0.0, 0.0)), v))
        plan = interaction.multiply(layout, table, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
        blocks = plan[plan.index("FlatMapCoGroups"):].split("Scan parquet")
        assert "Exchange" not in blocks[0] and "layout_blocks" in blocks[1]  # the matrix stays where it is
        layout.drop()
        assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u]) for u in want)


@pytest.mark.parametrize("size", [50, 1 << 18])
def test_products_in_shares_of_the_blocks(skewed, monkeypatch, size):
    """The same products where only few vectors may be on disk at once; nothing stays behind."""
    cells = interaction.interaction_matrix(skewed)
    table = cells.select("item_id").distinct().withColumn("a", F.col("item_id") * 1.0)
    layout = interaction.lay_out(cells, "item_id", "user_id", size)
    want = {r.user_id: r.a for r in interaction.multiply(layout, table, ["a"]).collect()}
    assert not layout.parts
    monkeypatch.setattr(interaction, "SENT_BYTES", max(1, layout.sent * 24 // 3))
    got = {r.user_id: r.a for r in interaction.multiply(layout, table, ["a"]).collect()}
    folders = [p.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:") for p in layout.parts]
    assert got == pytest.approx(want) and len(folders) >= 3
    layout.clear()
    layout.drop()
    assert not any(os.path.exists(f) for f in folders)


def test_factors_leave_no_stored_tables(spark, skewed):
    session.ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{folder}/stored-*"))
    interaction.factorize(skewed, k_max=3)
    assert set(glob.glob(f"{folder}/stored-*")) == before


def test_z_test(spark):
    groups = spark.createDataFrame([("treatment", 30, 200), ("control", 15, 200)], "group string, conversions long, sample_size long")
    row = experiment.two_proportion_z_test(groups).first()
    assert row.z_value == pytest.approx(2.3735, abs=1e-3) and row.p_value == pytest.approx(0.01762, abs=1e-4)


def test_equal_scores(spark):
    units = spark.range(40).select(F.col("id").alias("experiment_unit_id"), (F.col("id") % 2).cast("int").alias("label"), F.lit(0.5).alias("score"))
    assigned = experiment.stratified_assignment(experiment.target_population(units))
    assert {r.ab_group: r["count"] for r in assigned.groupBy("ab_group").count().collect()} == {"treatment": 20, "control": 20}
    assert {r.score_segment for r in experiment.score_segment_analysis(assigned).collect()} == {"全部"}


def test_few_units_take_the_best_twenty(spark):
    units = spark.range(50).select(F.col("id").alias("experiment_unit_id"), F.lit(1).alias("label"), (F.col("id") / 50).alias("score"))
    targets = experiment.target_population(units)
    assert targets.count() == 20 and targets.first().threshold == pytest.approx(0.6)
