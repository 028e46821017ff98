"""The stages in a row, with few trees."""

import os

import pytest

import shoptrail
from shoptrail.functions import constants as K
from shoptrail.sources.adapters import dense_events, sparse_events

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


def test_exports():
    assert all(callable(getattr(shoptrail, name)) for name in shoptrail.__all__)
    assert shoptrail.__version__


def test_reports(spark, tmp_path):
    events = dense_events(spark, FOLDER).drop("event_id")
    shoptrail.save_tables(shoptrail.run_sqlite_analysis(events), str(tmp_path / "sql"))
    shoptrail.save_tables(shoptrail.run_exploratory_analysis(events), str(tmp_path / "eda"))
    assert spark.read.parquet(str(tmp_path / "eda" / "drop_rate")).count() == 3
    assert spark.read.parquet(str(tmp_path / "sql" / "hot_items_top10")).count() == 10


def test_everything(spark):
    events = sparse_events(spark, FOLDER)
    result = shoptrail.run_full_pipeline(
        events, label_days=180, trials=1, tree_options={"n_estimators": 2, "max_depth": 3},
        search_options={"narrow": {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3)}},
        svd_options={"k_max": 4, "iterations": 1}, windows={"history_days": 1500, "label_days": 500},
        feature_options={"with_svd": False, "trees": 5, "top": 10})
    assert result["data"]["cleaned"].count() == 6000
    final = result["features"]["final"]
    assert len(final.columns) == 13 and {r["split"] for r in final.select("split").distinct().collect()} == {"train", "valid", "test"}
    comparison = shoptrail.run_model_comparison(result["models"]).collect()
    assert sorted(r["Rank"] for r in comparison) == [1, 2, 3]
    assert result["interests"]["samples"].filter("label = 1").count() > 0
    assert result["interests"]["comparison"].select("Model").distinct().count() == 4
    assert result["fusion"]["merged"].count() > 0
    for model in result["models"].values():
        assert model["best_params"].count() > 0
        assert model["classification_report"].count() == 15 and model["confusion_matrix"].count() == 6
    names = set(result["features"]["features"])
    for table in ("logistic_coefficients", "tree_importance", "core_features"):
        assert {r["feature"] for r in result["explanation"][table].collect()} == names
    scenarios = {r["scenario"]: r["sample_count"] for r in result["fusion"]["scenarios"].collect()}
    pairs = result["fusion"]["pairs"]
    assert pairs.filter("long_tail_item").count() == scenarios[K.SCENARIO_TAIL] > 0
    assert scenarios[K.SCENARIO_ALL] == pairs.count()
    assert result["campaign"]["category_recommendations"].filter("category is not null").count() > 0
