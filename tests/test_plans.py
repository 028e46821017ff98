"""Physical plans: no Python in the core, no one-task step on events, pruned scans, hash aggregates."""

import pytest

from shoptrail.operators import activity, cleaning, marts, rhythm, sequences
from shoptrail.sources import tables as io


@pytest.fixture(scope="module")
def stored(spark, skewed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    io.write_parquet(skewed, path)
    return io.scan_parquet(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CORE = {
    "user_table": marts.user_table, "item_table": marts.item_table, "user_item_table": marts.user_item_table,
    "time_features": rhythm.time_features, "item_lifecycle": rhythm.item_lifecycle_features,
    "dedup": lambda e: cleaning.dedup_events(e.drop("event_id")), "sequence": sequences.behavior_sequence_features,
    "weekly": lambda e: activity.weekly_active_users(e).limit(5),
}


@pytest.mark.parametrize("name", CORE)
def test_core_plans(stored, name):
    text = plan(CORE[name](stored))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    body = text.split("Subquery")[0]
    assert "SinglePartition" not in body


@pytest.mark.parametrize("name", ["user_table", "user_item_table", "time_features", "dedup"])
def test_hash_aggregates(stored, name):
    assert "SortAggregate" not in plan(CORE[name](stored))


def test_pruned_scan(stored):
    assert "ReadSchema: struct<user_id:bigint,time:timestamp_ntz>" in plan(rhythm.time_features(stored))
