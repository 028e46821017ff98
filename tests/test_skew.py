"""Paths for hot keys give the same rows as the plain ones."""

from pyspark.sql import functions as F

from shoptrail.operators import joins, sequences
from shoptrail.operators.dataset import smote_oversample


def test_hot_keys_are_found(skewed):
    assert [r[0] for r in joins.hot_keys(skewed, "user_id", min_rows=500).collect()] == [1]
    assert joins.hot_keys(skewed, "user_id").isEmpty()
    assert joins.hot_keys(skewed, "user_id", min_rows=0).count() <= 4  # partitions


def test_salted_join_equals_join(spark, skewed):
    side = skewed.filter("user_id < 30").groupBy("user_id").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        plain = skewed.join(side, "user_id", how)
        salted = joins.hot_key_join(skewed, side, "user_id", how, min_rows=20)
        assert salted.select(plain.columns).exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_null_keys_spread_and_stay(spark, skewed):
    big = skewed.withColumn("user_id", F.when(F.col("user_id") != 1, F.col("user_id")))
    side = skewed.select("user_id").distinct().withColumn("n", F.lit(1))
    assert [r[0] for r in joins.hot_keys(big, "user_id", min_rows=500).collect()] == [None]
    salted = joins.hot_key_join(big, side, "user_id", "left", min_rows=500)
    assert salted.count() == 3000 and salted.filter("n is null").count() == big.filter("user_id is null").count()


def test_sliced_user_equals_whole_user(skewed):
    plain = sequences.previous_event(skewed)
    sliced = sequences.previous_event(skewed, min_rows=50)
    columns = ["event_id", "previous_time", "previous_behavior_type"]
    # rows equal in the sort order may swap; compare what the order defines
    key = ["user_id", "time", "item_id", "behavior_type", "previous_time", "previous_behavior_type"]
    assert sliced.count() == 3000 and columns[0] in sliced.columns
    assert plain.select(key).exceptAll(sliced.select(key)).count() == 0
    a = sequences.behavior_transition_matrix(skewed)
    b = sequences.behavior_transition_matrix(skewed, min_rows=50)
    assert a.exceptAll(b).count() == 0


def test_sliced_user_with_null_codes_users_and_day_times(spark, skewed):
    messy = skewed.withColumns({
        "behavior_type": F.when(F.col("event_id") % 3 != 0, F.col("behavior_type")),
        "user_id": F.when(F.col("user_id") != 1, F.col("user_id")),
        "time": F.date_trunc("day", "time").cast("timestamp_ntz")})
    messy = messy.unionByName(messy.filter("event_id % 2 = 0"))  # equal rows
    key = ["user_id", "time", "item_id", "behavior_type", "previous_time", "previous_behavior_type"]
    plain, sliced = (sequences.previous_event(messy, min_rows=n).select(key) for n in (10**9, 50))
    assert sliced.count() == messy.count()
    assert plain.exceptAll(sliced).count() == 0
    a, b = (sequences.behavior_transition_matrix(messy, min_rows=n) for n in (10**9, 50))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_last_n_limits_before_the_shuffle(skewed):
    frame = sequences.last_n_events(skewed, 5)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial and final
    assert frame.filter("user_id = 1").count() == 5


def _points(spark, values):
    rows = [(str(i), [float(x) for x in p]) for i, p in enumerate(values)]
    return spark.createDataFrame(rows, "_key string, _v array<double>").repartition(4)


def test_smote_neighbours_match_brute_force(spark):
    import numpy as np
    from shoptrail.operators.oversampling import nearest

    points = np.random.default_rng(1).random((60, 3))
    df = _points(spark, points)
    got = {}
    for r in nearest(df, df, 3, 5).collect():
        got.setdefault(int(r["_base"]), {})[r["_place"]] = int(r["_other"])
    for i, p in enumerate(points):
        order = [j for j in np.argsort(((points - p) ** 2).sum(1)) if j != i][:5]
        assert [got[i][n] for n in range(1, 6)] == order


def test_smote_neighbours_in_many_blocks(spark):
    """Recall against brute force with blocks far smaller than the data; a third of the points are equal."""
    import numpy as np
    from shoptrail.operators.oversampling import blocks, nearest

    rng = np.random.default_rng(2)
    points = rng.normal(size=(3000, 8))
    points[:1000] = 1.5
    points[1000] = 900.0
    df = _points(spark, points)
    sizes = [r["count"] for r in blocks(df, 8, 5, 2, 128).groupBy("tree", "leaf").count().collect()]
    assert max(sizes) <= 128 and min(sizes) > 5
    found = nearest(df, df, 8, 5, size=128).collect()
    assert len(found) == 15_000
    hits = 0
    true = {i: np.sort(((points - points[i]) ** 2).sum(1))[1:6] for i in range(len(points))}
    for r in found:
        hits += r["_d"] <= true[int(r["_base"])][-1] + 1e-9
    assert hits / 15_000 >= 0.9


def test_smote_plan_does_not_grow_with_the_data(spark):
    plans = []
    for n in (300, 3000):
        df = spark.range(n).select(F.col("id").alias("user_id"), F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5 == 0).cast("int").alias("label"))
        plans.append(len(smote_oversample(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert abs(plans[0] - plans[1]) <= 6


def test_smote_of_gaps_and_repeats(spark):
    rows = [(i, float(i), float(-i), 0) for i in range(40)] + [(100 + i % 6, float(i), 1.0, 1) for i in range(9)]
    rows += [(None, 2.0, 3.0, 1), (200, None, 1.0, 1), (201, float("nan"), 1.0, 1)]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, label int")
    out = smote_oversample(df, ["a", "b"])
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 40, 1: 40}
    made = out.exceptAll(df.select("a", "b", "label")).collect()
    assert len(made) == 28 and all(0 <= r["a"] <= 8 and 1 <= r["b"] <= 3 for r in made)


def test_smote_balances(spark):
    rows = [(i, float(i % 7), float(i % 11), int(i % 5 == 0)) for i in range(100)]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, label int")
    out = smote_oversample(df, ["a", "b"])
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 80, 1: 80}
    again = smote_oversample(df.repartition(7), ["a", "b"])
    assert out.exceptAll(again).count() == 0


def test_percentiles_of_a_value_that_most_rows_share(spark):
    from shoptrail.functions.ordering import percent_rank_avg

    rows = [(i, 1.0 if i % 10 else float(i), None if i % 7 == 0 else -0.0 if i % 2 else 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double").repartition(4)
    plain = {tuple(r) for r in percent_rank_avg(df, {"a": "pa", "b": "pb"}, "k").collect()}
    made = percent_rank_avg(df, {"a": "pa", "b": "pb"}, "k", hot_rows=50)
    assert {tuple(r) for r in made.collect()} == plain
    assert "BroadcastHashJoin" in made._jdf.queryExecution().executedPlan().toString()
    values = sorted(r[1] for r in rows)
    for k, a, b, pa, pb in plain:
        ranks = [i + 1 for i, v in enumerate(values) if v == a]
        assert abs(pa - sum(ranks) / len(ranks) / 400) < 1e-12 and (pb is None) == (b is None)
