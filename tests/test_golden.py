"""Hand-checked results on eleven events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows_by
from shoptrail.operators import activity, business, dataset, marts, quality, rhythm, sequences


def test_time_features(micro):
    got = rows_by(rhythm.time_features(micro), "user_id")
    want = {1: (5, 9, 2, "上午", 2, 2), 2: (3, 10, 2, "上午", 2, 1), 3: (2, 7, 1, "上午", 2, 0), 4: (1, 18, 1, "晚上", 1, 1)}
    for user, values in want.items():
        r = got[user]
        assert (r.total_behavior_count, r.peak_active_hour, r.peak_hour_behavior_count, r.peak_active_period,
                r.peak_period_behavior_count, r.night_behavior_count) == values
        assert r.night_behavior_ratio == pytest.approx(values[5] / values[0])


def test_sequence_features(micro):
    got = rows_by(sequences.behavior_sequence_features(micro), "user_id")
    assert {u: (r.avg_behavior_interval_seconds, r.continuous_same_behavior_count) for u, r in got.items()} == {
        1: (241200.0, 0), 2: (23400.0, 1), 3: (3600.0, 0), 4: (None, 0)}


def test_transitions(micro):
    got = rows_by(sequences.behavior_transition_matrix(micro), "previous_behavior_type", "behavior_type")
    assert {k: r.transition_count for k, r in got.items()} == {
        (1, 2): 1, (1, 3): 1, (1, 4): 2, (2, 4): 1, (3, 3): 1, (4, 1): 1}
    totals = {}
    for (previous, _), r in got.items():
        totals[previous] = totals.get(previous, 0) + r.transition_probability
    assert all(v == pytest.approx(1) for v in totals.values())


def test_user_lifecycle(micro):
    got = rows_by(rhythm.user_lifecycle_features(micro), "user_id")
    assert {u: (r.active_days, r.max_continuous_active_days, r.churn_gap_days) for u, r in got.items()} == {
        1: (4, 2, 0), 2: (1, 1, 9), 3: (1, 1, 2), 4: (1, 1, 0)}


def test_item_lifecycle(micro):
    got = rows_by(rhythm.item_lifecycle_features(micro), "item_id")
    assert {i: (r.item_total_behavior_count, r.item_recent_7_behavior_count) for i, r in got.items()} == {
        10: (5, 1), 11: (1, 0), 12: (4, 2), 13: (1, 1)}
    assert got[11].heat_decay_score == 0 and got[12].category_item_count == 2


def test_rfm(micro):
    got = rows_by(business.rfm_features(micro), "user_id")
    assert {u: (r.recency_days, r.buy_frequency, r.behavior_value_score, r.R_score, r.F_score, r.M_score, r.rfm_value_score)
            for u, r in got.items()} == {
        1: (0, 2, 14, 6, 5, 5, 16), 2: (9, 0, 7, 2, 1, 4, 7), 3: (2, 1, 6, 3, 4, 2, 9), 4: (0, 0, 1, 5, 2, 1, 8)}


def test_labels(micro):
    # label window after 2024-01-05
    features = business.user_preference_score(micro)
    labelled = dataset.history_filter(dataset.purchase_label(features, micro, 7), micro, 7)
    assert {r.user_id: r.label for r in labelled.collect()} == {1: 1, 2: 0}


def test_weekly_users(micro):
    assert {r.week: r.weekly_active_users for r in activity.weekly_active_users_period(micro).collect()} == {
        "2024-01-01/2024-01-07": 2, "2024-01-08/2024-01-14": 3}


def test_mart_matches_fact_and_finds_damage(micro):
    mart = marts.user_item_table(micro)
    measures = {"ui_pv_count": marts.count_behavior(1), "last_behavior_time": F.max("time")}
    assert quality.reconcile_mart(micro, mart, ["user_id", "item_id"], measures).count() == 0
    damaged = mart.withColumn("ui_pv_count", F.when(F.col("user_id") == 1, 99).otherwise(F.col("ui_pv_count"))).filter("user_id <> 4")
    keys = {(r.user_id, r.item_id) for r in quality.reconcile_mart(micro, damaged, ["user_id", "item_id"], measures).collect()}
    assert keys == {(1, 10), (1, 11), (4, 13)}


def test_empty_events(spark, micro):
    none = micro.filter("false")
    assert rhythm.time_features(none).count() == 0
    assert marts.user_table(none).count() == 0
    assert business.business_features(none).count() == 0
    assert activity.behavior_ratio(none).count() == 0


def test_missing_time_and_unknown_codes(spark, micro):
    odd = micro.withColumn("time", F.when(F.col("event_id") != 11, F.col("time"))).withColumn(
        "behavior_type", F.when(F.col("event_id") == 6, 9).otherwise(F.col("behavior_type")))
    assert set(rows_by(rhythm.time_features(odd), "user_id")) == {1, 2, 3}
    assert quality.invalid_behavior_count(odd).first()[0] == 1
    assert rows_by(business.user_preference_score(odd), "user_id")[2].user_preference_score == 6


def test_item_with_two_categories(spark):
    rows = [(1, 1, 10, 2, 1, dt.datetime(2024, 1, 2)), (2, 2, 10, 1, 4, dt.datetime(2024, 1, 3))]
    events = spark.createDataFrame(rows, "event_id long, user_id long, item_id long, item_category int, behavior_type int, time timestamp_ntz")
    star = marts.star_schema(events)
    counts = activity.hot_categories(star["fact_user_behavior"], star["dim_item"]).collect()
    assert {(r.item_category, r.behavior_count) for r in counts} == {(1, 2), (2, 2)}
    assert marts.item_table(events).first().item_category == 2  # the earliest
    assert {r.item_category: r.conversion_rate for r in marts.category_table(events).collect()} == {2: 0.0, 1: None}


def test_scores_aggregate_the_events_once(micro):
    """Ranks, last day and scores read the written measures, and what is returned does not read the events at all."""
    found = business.rfm_features(micro)
    text = found._jdf.queryExecution().analyzed().toString()
    assert "behavior_type" not in text
