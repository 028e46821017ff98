"""Named queries over the table folders: one per operator, over whole tables.

A query takes (spark, folder) and returns a DataFrame. Double columns are rounded to 6 digits so
that sums added in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..functions import draws, ordering
from ..operators import activity, business, classifiers, cleaning, dataset, experiment, explain, explore
from ..operators import interaction, interest, joins, marts, metrics, quality, rhythm, samples, sequences
from ..operators import stacking, tuning, wide
from ..session import materialize
from ..sources import tables as io
from ..sources.adapters import dense_events as dense
from ..sources.adapters import sparse_events as sparse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LABEL_DAYS = 180  # the sparse events span years


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in doubles}) if doubles else df


def query(function):
    """Register a function of (spark, folder) under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: rounded(function(spark, folder))
    return function


# ---- shared inputs ----------------------------------------------------------------------

def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Scored rows with four probabilities, an item, a category and a price."""
    def table(name, *columns):
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    lines = table("lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = table("orders", "o_orderkey", "o_custkey")
    parts = table("part", "p_partkey", "p_brand", "p_retailprice")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)
    return rows.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("item_category"),
        (F.col("l_returnflag") == "A").cast("int").alias("label"),
        (F.col("l_discount") * 10).alias("logistic_prob"), (F.col("l_quantity") / 50).alias("xgboost_prob"),
        (F.col("l_tax") * 10).alias("din_prob"),
        ((F.col("l_discount") * 10 + F.col("l_quantity") / 50) / 2).alias("stacking_prob"),
        F.col("p_retailprice").alias("price"), F.col("l_linestatus").alias("status"))


def pair_predictions(spark, folder) -> DataFrame:
    """Predictions with one row per (user, item)."""
    probabilities = ("logistic_prob", "xgboost_prob", "din_prob", "stacking_prob")
    return predictions(spark, folder).groupBy("user_id", "item_id").agg(
        F.max("item_category").alias("item_category"), F.max("label").alias("label"),
        *[F.max(c).alias(c) for c in probabilities], F.max("price").alias("price"))


def labelled_users(spark, folder) -> DataFrame:
    """Funnel features of users with history, with the purchase label."""
    events = sparse(spark, folder)
    features = business.user_funnel(events)
    labelled = dataset.purchase_label(features, events, LABEL_DAYS)
    return materialize(dataset.history_filter(labelled, events, LABEL_DAYS))


FUNNEL_COLUMNS = ["pv_count", "fav_count", "cart_count", "buy_count",
                  "fav_to_pv_rate", "cart_to_fav_rate", "buy_to_cart_rate", "buy_to_pv_rate"]


def model_rows(spark, folder) -> tuple[DataFrame, list[str]]:
    """Time, sequence and business features of the sparse events, labelled, balanced, scaled and split."""
    events = materialize(sparse(spark, folder))
    table = wide.feature_table(
        rhythm.time_features(events), sequences.behavior_sequence_features(events), business.business_features(events))
    table = cleaning.fill_missing(table)
    rows = dataset.history_filter(dataset.purchase_label(table, events, LABEL_DAYS), events, LABEL_DAYS)
    rows = materialize(rows)
    rows = materialize(dataset.stratified_split(materialize(dataset.undersample_balanced(rows))))
    rows = dataset.target_encode(rows, ["peak_active_period"]).drop("peak_active_period")
    columns = dataset.numeric_columns(rows)
    ready = dataset.standardize(rows, columns).select("user_id", "label", "split", *columns)
    return materialize(ready), columns


def _parts(rows: DataFrame):
    return [rows.filter(F.col("split") == s) for s in ("train", "valid", "test")]


def _test_metrics(name: str, model, rows: DataFrame) -> DataFrame:
    _, valid, test = _parts(rows)
    return stacking.metrics_table(name, {
        "Validation": classifiers.score(model, valid), "Test": classifiers.score(model, test)})


# ---- sources ----------------------------------------------------------------------------

@query
def scan_parquet(spark, folder):
    return io.scan_parquet(spark, f"{folder}/events.parquet")


@query
def scan_columns(spark, folder):
    return io.scan_columns(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_shipdate"])


@query
def publish_star_schema(spark, folder):
    io.publish_star_schema(marts.star_schema(dense(spark, folder)))
    return io.query_sql(spark, """
        select 'dim_user' as name, count(*) as n from dim_user
        union all select 'dim_item', count(*) from dim_item
        union all select 'dim_time', count(*) from dim_time
        union all select 'fact_user_behavior', count(*) from fact_user_behavior""")


@query
def query_sql(spark, folder):
    io.publish_star_schema(marts.star_schema(sparse(spark, folder)))
    return io.query_sql(spark, """
        select i.item_category, f.behavior_type, count(*) as n, count(distinct f.user_id) as users
        from fact_user_behavior f join dim_item i on f.item_id = i.item_id
        group by i.item_category, f.behavior_type""")


# ---- quality ----------------------------------------------------------------------------

def gaps(spark, folder) -> DataFrame:
    """Dense events with NULL in place of code 0 and of the time of one category."""
    events = dense(spark, folder)
    return events.withColumns({
        "behavior_type": F.expr("nullif(behavior_type, 0)"),
        "time": F.when(F.col("item_category") != 0, F.col("time"))})


@query
def profile_shape(spark, folder):
    return quality.profile_shape(gaps(spark, folder))


@query
def invalid_id_counts(spark, folder):
    return quality.invalid_id_counts(dense(spark, folder))


@query
def duplicate_count(spark, folder):
    return quality.duplicate_count(sparse(spark, folder))


@query
def time_range(spark, folder):
    return quality.time_range(gaps(spark, folder))


@query
def invalid_behavior_count(spark, folder):
    return quality.invalid_behavior_count(dense(spark, folder))


@query
def quality_report(spark, folder):
    return quality.quality_report(gaps(spark, folder))


@query
def reconcile_mart(spark, folder):
    """Every key of a mart that keeps valid behaviours only, against all events."""
    events = dense(spark, folder)
    valid = events.filter(F.col("behavior_type").isin(*K.BEHAVIOURS))
    measures = {"action_count": F.count("*"), "buy_count": marts.count_behavior(K.BUY), "last_time": F.max("time")}
    mart = valid.groupBy("user_id", "item_id").agg(*[m.alias(c) for c, m in measures.items()])
    return quality.reconcile_mart(events, mart, ["user_id", "item_id"], measures)


@query
def missing_rate(spark, folder):
    return quality.missing_rate(rhythm.user_lifecycle_features(sparse(spark, folder)))


@query
def unique_count(spark, folder):
    return quality.unique_count(rhythm.user_lifecycle_features(sparse(spark, folder)))


@query
def duplicate_users(spark, folder):
    return quality.duplicate_users(sparse(spark, folder))


@query
def feature_quality_summary(spark, folder):
    table = rhythm.user_lifecycle_features(sparse(spark, folder))
    return quality.feature_quality_summary(table, wide.feature_table_cleaned(table))


# ---- cleaning ---------------------------------------------------------------------------

@query
def dedup_events(spark, folder):
    return cleaning.dedup_events(sparse(spark, folder))


@query
def dedup_rows(spark, folder):
    return cleaning.dedup_rows(sparse(spark, folder))


@query
def drop_nulls(spark, folder):
    return cleaning.drop_nulls(gaps(spark, folder))


@query
def parse_time(spark, folder):
    """Event times as text, unreadable for error events."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.col("ts").cast("string"))
    return cleaning.parse_time(events.select("event_id", text.alias("time")))


@query
def coerce_numeric(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return cleaning.coerce_numeric(events.select("event_id", text.alias("value")), ["value"])


@query
def drop_constant_columns(spark, folder):
    return cleaning.drop_constant_columns(rhythm.time_features(sparse(spark, folder)))


@query
def fill_missing(spark, folder):
    return cleaning.fill_missing(rhythm.user_lifecycle_features(sparse(spark, folder)))


@query
def replace_inf(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    kind = F.col("event_type")
    x = (F.when(kind == "error", float("inf")).when(kind == "click", float("-inf"))
         .when(kind == "signup", float("nan")).otherwise(F.col("value")))
    return cleaning.replace_inf(events.select("event_id", x.alias("value")), ["value"])


@query
def impute_train_median(spark, folder):
    users = labelled_users(spark, folder)
    sparse_rates = users.withColumns({c: F.expr(f"nullif({c}, 0)") for c in ("fav_count", "buy_to_pv_rate")})
    split = dataset.stratified_split(sparse_rates.select("user_id", "label", "fav_count", "buy_to_pv_rate"))
    train, valid, test = cleaning.impute_train_median(_parts(split), ["fav_count", "buy_to_pv_rate"])
    return joins.union_frames(train, valid, test)


@query
def clip(spark, folder):
    rows = predictions(spark, folder).select("user_id", "item_id", "logistic_prob", "xgboost_prob")
    return cleaning.clip_columns(rows, ["logistic_prob", "xgboost_prob"], 0.05, 0.95)


# ---- projections ------------------------------------------------------------------------

@query
def with_time_parts(spark, folder):
    return C.with_time_parts(dense(spark, folder)).select("event_id", "date", "hour", "weekday", "month")


@query
def with_behavior_flags(spark, folder):
    return C.with_behavior_flags(dense(spark, folder)).select("event_id", "is_browse", "is_fav", "is_cart", "is_buy")


@query
def with_time_period(spark, folder):
    return C.with_time_period(dense(spark, folder)).select("event_id", "time_period")


@query
def with_is_night(spark, folder):
    return C.with_is_night(dense(spark, folder)).select("event_id", "is_night")


@query
def behavior_weight_implicit(spark, folder):
    return C.with_implicit_weight(dense(spark, folder)).select("event_id", "behavior_score")


@query
def behavior_weight_value(spark, folder):
    return C.with_value_weight(dense(spark, folder)).select("event_id", "behavior_score")


@query
def active_level(spark, folder):
    counts = dense(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.withColumn("level", C.active_level(F.col("n")))


@query
def with_day_type(spark, folder):
    return C.with_day_type(dense(spark, folder)).select("event_id", "day_type")


@query
def week_label_period(spark, folder):
    return sparse(spark, folder).select("time", C.week_label_period(F.col("time")).alias("week")).distinct()


@query
def week_label_yw(spark, folder):
    return sparse(spark, folder).select("time", C.week_label_yw(F.col("time")).alias("week")).distinct()


@query
def safe_ratio(spark, folder):
    pairs = marts.user_item_table(dense(spark, folder))
    return pairs.select("user_id", "item_id", C.safe_ratio(F.col("ui_buy_count"), F.col("ui_pv_count")).alias("ratio"))


@query
def date_window(spark, folder):
    return C.recent_events(dense(spark, folder), 7).select("event_id", "time")


@query
def normalize_text_key(spark, folder):
    parts = io.scan_columns(spark, f"{folder}/part.parquet", ["p_partkey", "p_name", "p_type"])
    text = F.concat(F.lit(" "), F.col("p_type"), F.lit("-"), F.col("p_name"))
    return parts.select("p_partkey", C.normalize_text_key(text).alias("key"))


@query
def round_ratio(spark, folder):
    pairs = marts.user_item_table(dense(spark, folder))
    return pairs.select("user_id", "item_id", C.round_ratio(F.col("ui_buy_count"), F.col("ui_pv_count")).alias("ratio"))


# ---- joins ------------------------------------------------------------------------------

@query
def left_join_user(spark, folder):
    events = dense(spark, folder)
    recent = C.recent_events(events, 1)
    return joins.left_join_user(
        rhythm.peak_period(events), rhythm.max_active_streak(events), business.user_funnel(recent))


@query
def left_join_item(spark, folder):
    events = sparse(spark, folder)
    items = marts.item_table(events).select("item_id", "item_category", "item_action_count")
    recent = C.recent_events(events, 30).groupBy("item_id").agg(F.count("*").alias("recent"))
    categories = marts.category_table(events).select("item_category", "item_count")
    return joins.left_join_category(joins.left_join_item(items, recent), categories)


@query
def total_by_group_join(spark, folder):
    return joins.total_by_group_join(rhythm.hour_counts(dense(spark, folder)), "user_id", "n", "total")


@query
def fact_dim_join(spark, folder):
    star = marts.star_schema(sparse(spark, folder))
    return joins.fact_dim_join(star["fact_user_behavior"], star["dim_item"])


@query
def segment_inner_join(spark, folder):
    events = dense(spark, folder)
    return explore.segment_inner_join(events, explore.rfm_segment(events))


@query
def semi_join_users(spark, folder):
    events = sparse(spark, folder)
    return joins.semi_join_users(business.user_funnel(events), dataset.label_buyers(events, LABEL_DAYS))


@query
def label_pair_join(spark, folder):
    events = sparse(spark, folder)
    pairs = events.select("user_id", "item_id").distinct()
    return joins.label_pair_join(pairs, events.filter(F.col("behavior_type") == K.BUY))


@query
def align_predictions(spark, folder):
    pairs = pair_predictions(spark, folder)
    keys = ["user_id", "item_id"]
    return stacking.align_predictions(
        pairs.select(*keys, "label", "logistic_prob"),
        pairs.filter(F.col("xgboost_prob") > 0.2).select(*keys, "label", "xgboost_prob"),
        pairs.filter(F.col("din_prob") < 0.8).select(*keys, "label", "din_prob"), keys)


@query
def attach_features(spark, folder):
    rows = pair_predictions(spark, folder).select("user_id", "item_id", "logistic_prob")
    repeated = sparse(spark, folder).select("user_id", F.col("behavior_type").alias("code"), F.col("item_category").alias("category"))
    return joins.attach_features(rows, repeated, "user_id")


@query
def lookup_join(spark, folder):
    events = dense(spark, folder).select("event_id", F.expr("nullif(behavior_type, 0)").alias("behavior_type"))
    counts = events.groupBy("behavior_type").agg(F.count("*").alias("n"))
    return joins.lookup_join(events, counts, "behavior_type")


@query
def repurchase_left_join(spark, folder):
    return activity.repurchase_left_join(dense(spark, folder))


# ---- marts and reports ------------------------------------------------------------------

@query
def user_table(spark, folder):
    return marts.user_table(sparse(spark, folder))


@query
def item_table(spark, folder):
    return marts.item_table(sparse(spark, folder))


@query
def time_table(spark, folder):
    return marts.time_table(sparse(spark, folder))


@query
def category_table(spark, folder):
    return marts.category_table(sparse(spark, folder))


@query
def user_item_table(spark, folder):
    return marts.user_item_table(sparse(spark, folder))


@query
def star_schema(spark, folder):
    """The time dimension; the other tables have queries of their own."""
    return marts.star_schema(sparse(spark, folder))["dim_time"]


@query
def star_users(spark, folder):
    return marts.star_schema(sparse(spark, folder))["dim_user"]


@query
def star_items(spark, folder):
    return marts.star_schema(sparse(spark, folder))["dim_item"]


@query
def star_fact(spark, folder):
    return marts.star_schema(sparse(spark, folder))["fact_user_behavior"].select("time", "user_id", "item_id", "behavior_type")


@query
def total_behavior_count(spark, folder):
    return activity.total_behavior_count(sparse(spark, folder))


@query
def behavior_count(spark, folder):
    return activity.behavior_count(sparse(spark, folder))


@query
def behavior_ratio(spark, folder):
    return activity.behavior_ratio(sparse(spark, folder))


@query
def daily_active_users(spark, folder):
    return activity.daily_active_users(dense(spark, folder))


@query
def weekly_active_users(spark, folder):
    return activity.weekly_active_users(sparse(spark, folder))


@query
def weekly_active_users_period(spark, folder):
    return activity.weekly_active_users_period(sparse(spark, folder))


@query
def hot_items_top10(spark, folder):
    return activity.hot_items(sparse(spark, folder))


@query
def hot_categories_top10(spark, folder):
    star = marts.star_schema(sparse(spark, folder))
    return activity.hot_categories(star["fact_user_behavior"], star["dim_item"])


@query
def funnel_users(spark, folder):
    return activity.funnel_users(sparse(spark, folder))


@query
def user_group(spark, folder):
    return activity.user_group(sparse(spark, folder))


@query
def repurchase_rate_top10(spark, folder):
    return activity.repurchase_rate_top(dense(spark, folder))


@query
def hour_distribution(spark, folder):
    return explore.hour_distribution(dense(spark, folder))


@query
def hour_conversion_rate(spark, folder):
    return explore.hour_conversion_rate(dense(spark, folder))


@query
def conversion_funnel(spark, folder):
    return explore.conversion_funnel(sparse(spark, folder))


@query
def drop_rate(spark, folder):
    return explore.drop_rate(sparse(spark, folder))


@query
def rfm_buyers(spark, folder):
    return explore.rfm_buyers(sparse(spark, folder))


@query
def rfm_segment(spark, folder):
    return explore.rfm_segment(sparse(spark, folder))


@query
def segment_count(spark, folder):
    return explore.segment_count(explore.rfm_segment(sparse(spark, folder)))


@query
def segment_behavior(spark, folder):
    events = sparse(spark, folder)
    return explore.segment_behavior(events, explore.rfm_segment(events))


@query
def category_conversion_rate(spark, folder):
    return explore.category_conversion_rate(sparse(spark, folder))


@query
def repurchase_overall(spark, folder):
    return explore.repurchase_overall(dense(spark, folder))


@query
def top_repurchased_items(spark, folder):
    return explore.top_repurchased_items(dense(spark, folder))


@query
def day_type_behavior(spark, folder):
    return explore.day_type_behavior(sparse(spark, folder))


@query
def eda_summary(spark, folder):
    return explore.eda_summary(sparse(spark, folder))


@query
def label_distribution(spark, folder):
    return explore.label_distribution(labelled_users(spark, folder))


@query
def pivot_counts(spark, folder):
    return activity.pivot_counts(dense(spark, folder))


# ---- order and ranks --------------------------------------------------------------------

@query
def peak_hour(spark, folder):
    return rhythm.peak_hour(dense(spark, folder))


@query
def peak_period(spark, folder):
    return rhythm.peak_period(dense(spark, folder))


@query
def previous_event(spark, folder):
    return sequences.previous_event(dense(spark, folder)).select(
        "event_id", "previous_time", "previous_behavior_type")


@query
def same_behavior_as_previous(spark, folder):
    return sequences.same_behavior_as_previous(dense(spark, folder)).select("event_id", "is_same_behavior")


@query
def max_active_streak(spark, folder):
    return rhythm.max_active_streak(dense(spark, folder))


@query
def rank_first(spark, folder):
    counts = sparse(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    return ordering.global_rank(counts, ["n", "user_id"])


def _joined(df: DataFrame) -> DataFrame:
    """Arrays as text, for the comparison."""
    return df.withColumns({c: F.array_join(c, ",") for c in ("item_seq", "cate_seq", "behavior_seq")})


@query
def last_n_sequence(spark, folder):
    return _joined(sequences.last_n_sequence(cleaning.dedup_events(dense(spark, folder).drop("event_id"))))


@query
def qcut_codes(spark, folder):
    counts = sparse(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    users = counts.select(F.count("*")).scalar()
    ranked = ordering.global_rank(counts, ["n", "user_id"])
    return ranked.withColumn("code", ordering.qcut_codes(F.col("rank"), users, 5))


@query
def qcut_values(spark, folder):
    users = predictions(spark, folder).groupBy("user_id").agg(F.avg("price").alias("score"))
    return experiment.with_score_bins(users, 10, "code")


@query
def percent_rank_avg(spark, folder):
    counts = sparse(spark, folder).groupBy("item_id").agg(F.count("*").alias("n"))
    return ordering.percent_rank_avg(counts, {"n": "percent_rank"}, "item_id")


@query
def cut_fixed(spark, folder):
    rows = predictions(spark, folder).select("user_id", "item_id", F.col("xgboost_prob").alias("score"))
    return rows.withColumn("level", C.cut_fixed(F.col("score"), (0.4, 0.7), (K.PRIORITY_LOW, K.PRIORITY_MID, K.PRIORITY_HIGH)))


@query
def first_per_key(spark, folder):
    events = dense(spark, folder).select("event_id", "user_id", "item_id", "time")
    return sequences.first_per_key(events, ["user_id"], ["time", "event_id"])


# ---- top-k, unions, draws ---------------------------------------------------------------

@query
def behavior_sequence(spark, folder):
    return activity.behavior_sequence(sparse(spark, folder))


@query
def top_items(spark, folder):
    return activity.hot_items(dense(spark, folder), 20)


@query
def top_categories(spark, folder):
    return activity.top_categories(sparse(spark, folder), 20)


def _units(spark, folder) -> DataFrame:
    return materialize(experiment.experiment_units(
        predictions(spark, folder), score="stacking_prob", item="item_id", category="item_category", price="price"))


@query
def top_n_with_threshold(spark, folder):
    units = _units(spark, folder).withColumn("score", F.col("price"))
    return experiment.target_population(units)


@query
def rank_models(spark, folder):
    metric_rows = stacking.compare_base_and_stacking(pair_predictions(spark, folder))
    return stacking.rank_models(metric_rows)


@query
def union_frames(spark, folder):
    events = dense(spark, folder)
    views = events.filter(F.col("behavior_type") == K.BROWSE).select("user_id", "item_id")
    buys = events.filter(F.col("behavior_type") == K.BUY).select("item_id", "user_id")
    return joins.union_frames(views, buys)


@query
def sample_exact(spark, folder):
    return draws.sample_exact(marts.user_item_table(sparse(spark, folder)), 1000, ["user_id", "item_id"])


@query
def sample_cap(spark, folder):
    return draws.sample_cap(dense(spark, folder).select("event_id", "user_id", "item_id"), 500, ["event_id"])


@query
def distinct_users(spark, folder):
    return joins.distinct_users(sparse(spark, folder))


# ---- features ---------------------------------------------------------------------------

@query
def time_features(spark, folder):
    return rhythm.time_features(dense(spark, folder))


@query
def user_lifecycle_features(spark, folder):
    return rhythm.user_lifecycle_features(sparse(spark, folder))


@query
def item_lifecycle_features(spark, folder):
    return rhythm.item_lifecycle_features(sparse(spark, folder))


@query
def behavior_sequence_features(spark, folder):
    return sequences.behavior_sequence_features(dense(spark, folder))


@query
def behavior_transition_matrix(spark, folder):
    return sequences.behavior_transition_matrix(dense(spark, folder))


@query
def interaction_matrix(spark, folder):
    return interaction.interaction_matrix(sparse(spark, folder))


@query
def user_svd_features(spark, folder):
    return interaction.user_svd_features(sparse(spark, folder))


@query
def rfm_features(spark, folder):
    return business.rfm_features(sparse(spark, folder))


@query
def user_funnel(spark, folder):
    return business.user_funnel(sparse(spark, folder))


@query
def user_preference_score(spark, folder):
    return business.user_preference_score(dense(spark, folder))


@query
def business_features(spark, folder):
    return business.business_features(dense(spark, folder))


def _wide(spark, folder) -> DataFrame:
    events = dense(spark, folder)
    return wide.feature_table(
        rhythm.time_features(events), sequences.behavior_sequence_features(events), business.business_features(events))


@query
def feature_table(spark, folder):
    return _wide(spark, folder)


@query
def feature_table_cleaned(spark, folder):
    events = sparse(spark, folder)
    table = joins.left_join_user(rhythm.user_lifecycle_features(events), rhythm.peak_hour(events))
    return wide.feature_table_cleaned(materialize(table))


@query
def feature_table_with_factors(spark, folder):
    events = dense(spark, folder)
    return joins.left_join_user(_wide(spark, folder), interaction.user_svd_features(events))


# ---- model data -------------------------------------------------------------------------

@query
def purchase_label(spark, folder):
    events = sparse(spark, folder)
    return dataset.purchase_label(business.user_preference_score(events), events, LABEL_DAYS)


@query
def history_filter(spark, folder):
    events = sparse(spark, folder)
    return dataset.history_filter(business.user_preference_score(events), events, LABEL_DAYS)


@query
def undersample_balanced(spark, folder):
    return dataset.undersample_balanced(labelled_users(spark, folder))


@query
def target_encode(spark, folder):
    events = dense(spark, folder)
    periods = rhythm.peak_period(events).select("user_id", "peak_active_period")
    labelled = dataset.purchase_label(periods, events, 3)
    return dataset.target_encode(labelled, ["peak_active_period"])


@query
def standardize(spark, folder):
    return dataset.standardize(labelled_users(spark, folder), FUNNEL_COLUMNS)


@query
def build_samples(spark, folder):
    events = cleaning.dedup_events(dense(spark, folder).drop("event_id"))
    cutoff = samples.choose_cutoffs(events).select("train_cutoff").scalar()
    return samples.build_samples(events, cutoff, "train", with_sequences=False)


@query
def choose_cutoffs(spark, folder):
    return samples.choose_cutoffs(sparse(spark, folder))


@query
def build_time_split_dataset(spark, folder):
    events = cleaning.dedup_events(dense(spark, folder).drop("event_id"))
    return samples.build_time_split_dataset(events, with_sequences=False)


@query
def build_sequence_samples(spark, folder):
    """Samples with their item, category and behaviour arrays."""
    events = cleaning.dedup_events(dense(spark, folder).drop("event_id"))
    return _joined(samples.build_time_split_dataset(events))


@query
def encode_ids(spark, folder):
    return samples.encode_ids(dense(spark, folder)).select(
        "event_id", "user_id_idx", "item_id_idx", "item_category_idx", "behavior_type_idx")


@query
def pad_sequence(spark, folder):
    events = dense(spark, folder)
    days = events.groupBy("user_id").agg(F.sort_array(F.collect_set(F.dayofmonth("time"))).alias("days"))
    padded = sequences.pad_sequence(days, "days", 20)
    return padded.select("user_id", "days_length", F.array_join("days", ",").alias("days"))


@query
def stratified_split(spark, folder):
    return dataset.stratified_split(labelled_users(spark, folder)).select("user_id", "label", "split")


@query
def smote_oversample(spark, folder):
    return dataset.smote_oversample(labelled_users(spark, folder), FUNNEL_COLUMNS)


@query
def smote_balance(spark, folder):
    """Rows of each label after oversampling."""
    return dataset.smote_oversample(labelled_users(spark, folder), FUNNEL_COLUMNS).groupBy("label").agg(F.count("*").alias("n"))


@query
def smote_kept_rows(spark, folder):
    """The rows of the input, all of which oversampling has to keep."""
    rows = labelled_users(spark, folder)
    given = rows.select(*[F.col(c).cast("double").alias(c) for c in FUNNEL_COLUMNS], "label")
    return dataset.smote_oversample(rows, FUNNEL_COLUMNS).intersectAll(given)


@query
def class_weights(spark, folder):
    return dataset.class_weights(labelled_users(spark, folder))


@query
def scale_pos_weight(spark, folder):
    return dataset.scale_pos_weight(labelled_users(spark, folder))


@query
def label_correlation(spark, folder):
    return dataset.label_correlation(labelled_users(spark, folder), FUNNEL_COLUMNS)


@query
def feature_importance_rf(spark, folder):
    rows, columns = model_rows(spark, folder)
    return dataset.feature_importance_rf(rows, columns)


@query
def select_top_features(spark, folder):
    rows, columns = model_rows(spark, folder)
    return dataset.select_top_features(rows, dataset.feature_importance_rf(rows, columns), 12)  # of 27


@query
def dataset_summary(spark, folder):
    events = sparse(spark, folder)
    users = labelled_users(spark, folder)
    return dataset.dataset_summary({"labelled": users, "balanced": dataset.undersample_balanced(users)}, events, LABEL_DAYS)


# ---- models -----------------------------------------------------------------------------

@query
def train_logistic(spark, folder):
    rows, columns = model_rows(spark, folder)
    return _test_metrics("Logistic Regression", classifiers.train_logistic(_parts(rows)[0], columns), rows)


@query
def train_gbt_depthwise(spark, folder):
    rows, columns = model_rows(spark, folder)
    return _test_metrics("XGBoost", classifiers.train_gbt_depthwise(_parts(rows)[0], columns), rows)


@query
def train_gbt_leaf_limited(spark, folder):
    rows, columns = model_rows(spark, folder)
    return _test_metrics("LightGBM", classifiers.train_gbt_leaf_limited(_parts(rows)[0], columns), rows)


@query
def tune(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, valid, _ = _parts(rows)
    return tuning.tune_logistic(train, valid, columns).trials


TUNED_ROUNDS = {"n_estimators": ("int", 100, 200)}  # of the registered searches over trees; the functions search up to 800


@query
def tune_depthwise(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, valid, _ = _parts(rows)
    return tuning.tune_depthwise(train, valid, columns, narrow=TUNED_ROUNDS).trials


@query
def tune_leaf_limited(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, valid, _ = _parts(rows)
    return tuning.tune_leaf_limited(train, valid, columns, narrow=TUNED_ROUNDS).trials


@query
def evaluate_binary(spark, folder):
    return metrics.evaluate_binary(predictions(spark, folder), probability="xgboost_prob", by=["status"])


@query
def pr_auc(spark, folder):
    value = metrics.pr_auc(predictions(spark, folder), probability="xgboost_prob")
    return spark.createDataFrame([(value,)], "pr_auc double")


@query
def classification_report(spark, folder):
    return metrics.classification_report(predictions(spark, folder), probability="logistic_prob")


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(predictions(spark, folder), probability="logistic_prob")


@query
def score_test(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, _, test = _parts(rows)
    return classifiers.score(classifiers.train_logistic(train, columns), test)


@query
def model_comparison(spark, folder):
    rows = predictions(spark, folder)
    tables = {}
    for column, title in (("logistic_prob", "Logistic Regression"), ("xgboost_prob", "XGBoost"), ("din_prob", "DIN")):
        scored = rows.withColumn("probability", F.col(column))
        tables[title] = stacking.metrics_table(title, {
            "Validation": scored.filter(F.col("status") == "F"), " Test ": scored.filter(F.col("status") == "O")})
    return stacking.model_comparison(tables)


@query
def stack_models(spark, folder):
    stack = stacking.stack_models(materialize(pair_predictions(spark, folder).drop("stacking_prob")), ["user_id", "item_id"])
    return stack.test.select("user_id", "item_id", "label", "stacking_prob", "stacking_prediction")


@query
def compare_base_and_stacking(spark, folder):
    return stacking.compare_base_and_stacking(pair_predictions(spark, folder))


def _interest(spark, folder):
    events = materialize(cleaning.dedup_events(dense(spark, folder).drop("event_id")))
    cutoff = samples.choose_cutoffs(events).select("train_cutoff").scalar()
    seen = events.filter(F.col("time") < C.start_of(cutoff))
    factors = interaction.factorize(seen)
    return materialize(interest.interest_features(samples.build_time_split_dataset(events), factors.items))


@query
def sequence_interest_model(spark, folder):
    ready = _interest(spark, folder)
    return interest.score_interest(interest.train_interest_model(ready), ready)


@query
def training_history(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, valid, _ = _parts(rows)
    return classifiers.training_history(classifiers.train_gbt_depthwise(train, columns), valid)


@query
def standardize_predictions(spark, folder):
    rows = pair_predictions(spark, folder)
    text = F.when(F.col("xgboost_prob") > 0.9, "n/a").otherwise(F.col("xgboost_prob").cast("string"))
    return stacking.standardize_predictions(
        rows.withColumn("probability", text), "XGBoost", keys=("user_id", "item_id"))


# ---- explanation ------------------------------------------------------------------------

@query
def logistic_coefficients(spark, folder):
    rows, columns = model_rows(spark, folder)
    return explain.logistic_coefficients(classifiers.train_logistic(_parts(rows)[0], columns), columns, spark)


@query
def stacking_weights(spark, folder):
    stack = stacking.stack_models(materialize(pair_predictions(spark, folder).drop("stacking_prob")), ["user_id", "item_id"])
    return explain.stacking_weights(stack.model, spark)


@query
def tree_model_importance(spark, folder):
    rows, columns = model_rows(spark, folder)
    train, _, test = _parts(rows)
    return explain.tree_model_importance(classifiers.train_gbt_depthwise(train, columns), test, columns)


@query
def surrogate_importance(spark, folder):
    rows, columns = model_rows(spark, folder)
    train = _parts(rows)[0]
    scored = classifiers.score(classifiers.train_logistic(train, columns), rows, ("user_id", *columns))
    return explain.surrogate_importance(scored, columns, "probability")


@query
def core_features(spark, folder):
    users = labelled_users(spark, folder)
    correlation = dataset.label_correlation(users, FUNNEL_COLUMNS).withColumnRenamed("correlation", "importance")
    means = users.agg(*[F.avg(c).alias(c) for c in FUNNEL_COLUMNS[:4]])
    levels = means.unpivot([], FUNNEL_COLUMNS[:4], "feature", "importance")
    return explain.core_features({"XGBoost": correlation, "Logistic Regression": levels})


@query
def error_samples(spark, folder):
    rows = predictions(spark, folder).select("user_id", "item_id", "label", "stacking_prob")
    return explain.error_samples(rows)


@query
def cold_start_flag(spark, folder):
    rows = predictions(spark, folder).select("user_id", "item_id")
    return explain.cold_start_flag(rows, threshold=30)


@query
def long_tail_flag(spark, folder):
    rows = predictions(spark, folder).select("user_id", "item_id")
    return explain.long_tail_flag(rows)


@query
def scenario_metrics(spark, folder):
    rows = materialize(predictions(spark, folder).select("user_id", "item_id", "label", "stacking_prob"))
    return explain.scenario_metrics(explain.long_tail_flag(explain.cold_start_flag(rows, threshold=30)))


# ---- experiment -------------------------------------------------------------------------

def _assigned(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Target users, by mean price, and their assignment."""
    units = _units(spark, folder).withColumn("score", F.col("price"))
    targets = materialize(experiment.target_population(units))
    return targets, materialize(experiment.stratified_assignment(targets))


@query
def experiment_units(spark, folder):
    return _units(spark, folder)


@query
def target_population(spark, folder):
    return experiment.target_population(_units(spark, folder))


@query
def stratified_assignment(spark, folder):
    return _assigned(spark, folder)[1]


@query
def baseline_rate(spark, folder):
    return experiment.baseline_rate(_assigned(spark, folder)[1])


@query
def required_sample_size(spark, folder):
    return experiment.required_sample_size(experiment.baseline_rate(_assigned(spark, folder)[1]))


@query
def experiment_days(spark, folder):
    targets, assigned = _assigned(spark, folder)
    return experiment.experiment_days(experiment.required_sample_size(experiment.baseline_rate(assigned)), targets)


@query
def group_metrics(spark, folder):
    return experiment.group_metrics(_assigned(spark, folder)[1], "price")


@query
def two_proportion_z_test(spark, folder):
    return experiment.two_proportion_z_test(experiment.group_metrics(_assigned(spark, folder)[1])).select("z_value")


@query
def effect_summary(spark, folder):
    targets, assigned = _assigned(spark, folder)
    sizes = experiment.experiment_days(experiment.required_sample_size(experiment.baseline_rate(assigned)), targets)
    summary = experiment.effect_summary(experiment.group_metrics(assigned, "price"), sizes)
    return summary.drop("p_value", "statistically_significant")


@query
def experiment_significance(spark, folder):
    """p value and verdict; its SQL sums the series of the normal tail."""
    targets, assigned = _assigned(spark, folder)
    sizes = experiment.experiment_days(experiment.required_sample_size(experiment.baseline_rate(assigned)), targets)
    summary = experiment.effect_summary(experiment.group_metrics(assigned, "price"), sizes)
    return summary.select("z_value", "p_value", "statistically_significant")


@query
def score_segment_analysis(spark, folder):
    return experiment.score_segment_analysis(_assigned(spark, folder)[1])


@query
def category_recommendations(spark, folder):
    return experiment.category_recommendations(_assigned(spark, folder)[1])


# ---- contracts and shapes ---------------------------------------------------------------

@query
def downcast(spark, folder):
    return cleaning.downcast(dense(spark, folder))


@query
def union_optional(spark, folder):
    """Users of one report and items of another in one table, missing columns NULL."""
    events = dense(spark, folder)
    users = events.groupBy("user_id").agg(F.count("*").alias("n"))
    items = events.groupBy("item_id").agg(F.count("*").alias("n"), F.max("time").alias("latest"))
    return joins.union_optional(users.withColumn("item_id", F.lit(None).cast("int")), items)


@query
def require_domain(spark, folder):
    """Passes its rows on, or refuses them."""
    from ..operators.contracts import require_domain as check

    rows = predictions(spark, folder).select("user_id", "item_id", "label", F.col("xgboost_prob").alias("score"))
    return check(rows, ["label"], ["score"], 1)


@query
def drop_columns_by_pattern(spark, folder):
    rows = predictions(spark, folder)
    return rows.select(*C.drop_columns_by_pattern(rows, ("label", "prob")))
