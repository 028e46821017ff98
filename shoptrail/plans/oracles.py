"""The same results in plain SQL over the same tables, for checking the catalog.

``dense`` and ``sparse`` are the two event views, ``pred`` the scored rows. Float columns are
rounded to 6 digits as in the catalog.
"""

from __future__ import annotations

DENSE = """dense as (
  select event_id, user_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as item_id,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) % 10 as item_category,
         case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3
                         when 'purchase' then 4 else 0 end as behavior_type,
         ts as time
  from events)"""

SPARSE = """sparse as (
  select o.o_custkey as user_id, l.l_partkey as item_id,
         cast(regexp_extract(p.p_brand, '([0-9]+)', 1) as int) as item_category,
         case when l.l_returnflag = 'A' and l.l_linestatus = 'F' then 4
              when l.l_returnflag = 'R' and l.l_linestatus = 'F' then 3
              when l.l_returnflag = 'A' and l.l_linestatus = 'O' then 2 else 1 end as behavior_type,
         l.l_shipdate as time
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey)"""

PRED = """pred as (
  select o.o_custkey as user_id, l.l_partkey as item_id,
         cast(regexp_extract(p.p_brand, '([0-9]+)', 1) as int) as item_category,
         cast(l.l_returnflag = 'A' as int) as label,
         l.l_discount * 10 as logistic_prob, l.l_quantity / 50 as xgboost_prob, l.l_tax * 10 as din_prob,
         (l.l_discount * 10 + l.l_quantity / 50) / 2 as stacking_prob,
         p.p_retailprice as price, l.l_linestatus as status
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey),
pairs as (
  select user_id, item_id, max(item_category) as item_category, max(label) as label,
         max(logistic_prob) as logistic_prob, max(xgboost_prob) as xgboost_prob, max(din_prob) as din_prob,
         max(stacking_prob) as stacking_prob, max(price) as price
  from pred group by 1, 2)"""

FUNNEL = """funnel as (
  select *, coalesce(fav_count / nullif(pv_count, 0), 0) as fav_to_pv_rate,
         coalesce(cart_count / nullif(fav_count, 0), 0) as cart_to_fav_rate,
         coalesce(buy_count / nullif(cart_count, 0), 0) as buy_to_cart_rate,
         coalesce(buy_count / nullif(pv_count, 0), 0) as buy_to_pv_rate
  from (select user_id, count(*) filter (behavior_type = 1) as pv_count,
               count(*) filter (behavior_type = 2) as fav_count, count(*) filter (behavior_type = 3) as cart_count,
               count(*) filter (behavior_type = 4) as buy_count
        from {view} group by user_id))"""

LABELLED = SPARSE + ", " + FUNNEL.format(view="sparse") + """,
window_start as (select max(time)::date - 179 as d from sparse),
label_buyers as (select distinct user_id from sparse, window_start where time >= d and behavior_type = 4),
history as (select distinct user_id from sparse, window_start where time < d),
labelled as (
  select f.*, cast(b.user_id is not null as int) as label
  from funnel f left join label_buyers b using (user_id) where f.user_id in (select user_id from history))"""

GAPS = DENSE + """,
gaps as (select event_id, user_id, item_id, item_category, nullif(behavior_type, 0) as behavior_type,
                case when item_category <> 0 then time end as time from dense)"""

LIFECYCLE = SPARSE + """,
days as (select user_id, time::date as date, count(*) as n from sparse group by 1, 2),
newest as (select max(date) as m from days),
streaks as (select user_id, max(c) as s from (
              select user_id, g, count(*) as c from (
                select user_id, date - cast(row_number() over (partition by user_id order by date) as int) as g from days)
              group by 1, 2) group by 1),
lifecycle as (
  select d.user_id, sum(n)::bigint as total_behavior_count, count(*) as active_days,
         (sum(n) filter (date >= m - 30))::bigint as recent_30_behavior_count,
         case when sum(n) filter (date >= m - 30) >= 100 then '短期高活跃用户'
              when sum(n) filter (date >= m - 30) >= 30 then '短期中活跃用户'
              when sum(n) filter (date >= m - 30) is not null then '短期低活跃用户' end as short_term_active_level,
         max(date) as last_active_date, cast(m - max(date) as int) as churn_gap_days,
         max(s.s) as max_continuous_active_days
  from days d cross join newest join streaks s using (user_id) group by d.user_id, m)"""
LIFECYCLE_COLUMNS = ("user_id", "total_behavior_count", "active_days", "recent_30_behavior_count",
                     "short_term_active_level", "last_active_date", "churn_gap_days", "max_continuous_active_days")

PERIOD = """case when hour(time) < 6 then '凌晨' when hour(time) < 12 then '上午'
                 when hour(time) < 18 then '下午' else '晚上' end"""

TIME_FEATURES = """hours as (select user_id, hour(time)::int as h, count(*) as n from {view} group by 1, 2),
periods as (select user_id, """ + PERIOD + """ as p, count(*) as n from {view} group by 1, 2),
totals as (select user_id, count(*) as t, count(*) filter (hour(time) >= 18 or hour(time) < 6) as night from {view} group by 1),
best_hour as (select * from (select *, row_number() over (partition by user_id order by n desc, h) as r from hours) where r = 1),
best_period as (select * from (select *, row_number() over (partition by user_id order by n desc, p) as r from periods) where r = 1),
time_features as (
  select t.user_id, t.t as total_behavior_count, h.h as peak_active_hour, h.n as peak_hour_behavior_count,
         h.n / t.t as peak_hour_behavior_ratio, p.p as peak_active_period, p.n as peak_period_behavior_count,
         p.n / t.t as peak_period_behavior_ratio, t.night as night_behavior_count, t.night / t.t as night_behavior_ratio
  from totals t join best_hour h using (user_id) join best_period p using (user_id))"""

LAGGED = """lagged as (
  select *, lag(time) over w as previous_time, lag(behavior_type) over w as previous_behavior_type
  from {view} window w as (partition by user_id order by time, item_id, behavior_type))"""

SEQUENCE = LAGGED + """,
sequence_features as (
  select user_id, sum(epoch_us(time) - epoch_us(previous_time)) / 1e6 / count(previous_time) as avg_behavior_interval_seconds,
         count(*) filter (behavior_type = previous_behavior_type) as continuous_same_behavior_count
  from lagged group by user_id)"""

BUSINESS = FUNNEL + """,
measures as (
  select user_id, max(time)::date as last_behavior_date,
         cast((select max(time)::date from {view}) - max(time)::date as int) as recency_days,
         count(*) filter (behavior_type = 4) as buy_frequency,
         coalesce(sum(case behavior_type when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 5 end), 0)::bigint as behavior_value_score
  from {view} group by user_id),
ranks as (
  select *, count(*) over () as n, row_number() over (order by recency_days, user_id) as rr,
         row_number() over (order by buy_frequency, user_id) as rf,
         row_number() over (order by behavior_value_score, user_id) as rm from measures),
rfm as (
  select user_id, last_behavior_date, recency_days, buy_frequency, behavior_value_score,
         6 - greatest(ceil((rr - 1) * 5 / (n - 1))::bigint - 1, 0) as "R_score",
         1 + greatest(ceil((rf - 1) * 5 / (n - 1))::bigint - 1, 0) as "F_score",
         1 + greatest(ceil((rm - 1) * 5 / (n - 1))::bigint - 1, 0) as "M_score" from ranks),
rfm_features as (select *, "R_score" + "F_score" + "M_score" as rfm_value_score from rfm),
business as (
  select r.*, f.* exclude (user_id), r.behavior_value_score as user_preference_score
  from rfm_features r join funnel f using (user_id))"""

RATES = ("fav_to_pv_rate", "cart_to_fav_rate", "buy_to_cart_rate", "buy_to_pv_rate")

SEGMENTS = """buyers as (
  select user_id, cast((select max(time)::date from {view} where behavior_type = 4) - max(time)::date as int) as recency,
         count(*) as frequency from {view} where behavior_type = 4 group by 1),
ranked as (select *, count(*) over () as n, row_number() over (order by recency, user_id) as rr,
                  row_number() over (order by frequency, user_id) as rf from buyers),
scored as (
  select user_id, recency, frequency, 4 - greatest(ceil((rr - 1) * 4 / (n - 1))::bigint - 1, 0) as r_score,
         1 + greatest(ceil((rf - 1) * 4 / (n - 1))::bigint - 1, 0) as f_score from ranked),
segments as (
  select *, f_score as m_score,
         case when r_score >= 3 and f_score >= 3 then 'High Value' when r_score >= 3 then 'Potential'
              when f_score >= 3 then 'At Risk' else 'Dormant' end as segment from scored)"""

STAGES = """users as (
  select count(distinct user_id) filter (behavior_type = 1) as v, count(distinct user_id) filter (behavior_type = 2) as f,
         count(distinct user_id) filter (behavior_type = 3) as c, count(distinct user_id) filter (behavior_type = 4) as b
  from sparse),
drops as (
  select 1 as i, 'View -> Favorite' as step, 1 - f / v as drop_rate from users
  union all select 2, 'Favorite -> Cart', 1 - c / f from users
  union all select 3, 'Cart -> Buy', 1 - b / c from users),
marked as (select step, drop_rate, i = (select i from drops order by drop_rate desc, i limit 1) as is_largest from drops)"""

UNITS = PRED + """,
units as (
  select user_id as experiment_unit_id, max(label) as label, max(stacking_prob) as score,
         min(item_id) as item_id, min(item_category) as item_category, avg(price) as price
  from pred group by 1)"""

ASSIGNED = UNITS + """,
priced as (select * replace (price as score) from units),
cut as (select quantile_cont(score, 0.8) as threshold from priced),
targets as (select priced.*, threshold from priced, cut where score >= threshold),
edges as (select sorted as e from (
  select list(x order by x) as sorted from (
    select distinct unnest(quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) as x from targets))),
strata as (select targets.*, len(list_filter(e[2:len(e) - 1], lambda x: x < score)) as score_stratum from targets, edges),
placed as (
  select *, count(*) over (partition by score_stratum) as n,
         row_number() over (partition by score_stratum order by md5(concat_ws('|', experiment_unit_id, '42'))) as r from strata),
assigned as (
  select * exclude (n, r),
         case when r <= least(greatest(round_even(n * 0.5, 0), 1), greatest(n - 1, 1)) then 'treatment' else 'control' end as ab_group
  from placed),
base as (
  select coalesce(nullif(greatest(avg(label) filter (ab_group = 'control'), 0), 0), nullif(avg(label), 0), 0.01) as baseline_rate from assigned),
sizes as (
  select baseline_rate, cast(coalesce(ceil(power(1.959963984540054 * sqrt(2 * m * (1 - m))
           + 0.8416212335729143 * sqrt(c * (1 - c) + t * (1 - t)), 2) / nullif(power(t - c, 2), 0)), 0) as bigint) as required_sample_per_group
  from (select *, (c + t) / 2 as m from (
    select *, least(greatest(c * 1.15, 0.001), 0.999) as t from (
      select baseline_rate, least(greatest(baseline_rate, 0.001), 0.999) as c from base)))),
timed as (
  select *, cast(least(greatest(ceil(required_sample_per_group * 2 /
           greatest(floor((select count(*) from targets) * 0.1), 1)), 14), 28) as int) as experiment_days from sizes),
groups as (
  select ab_group as "group", count(*) as sample_size, sum(label)::bigint as conversions, avg(label) as conversion_rate,
         (select median(price) from assigned where price > 0) as average_order_value from assigned group by 1),
money as (
  select *, conversions * average_order_value as revenue,
         case when "group" = 'treatment' then sample_size * 2.0 else 0.0 end::double as marketing_cost from groups),
group_metrics as (
  select *, revenue * 0.3 as variable_cost, revenue - revenue * 0.3 - marketing_cost as gross_profit from money),
both_groups as (select t.*, c.conversion_rate as c_rate, c.sample_size as c_n, c.conversions as c_conv
                from group_metrics t, group_metrics c where t."group" = 'treatment' and c."group" = 'control'),
z as (select *, case when se = 0 then 0 else (conversion_rate - c_rate) / se end as z_value from (
  select *, sqrt(q * (1 - q) * (1 / sample_size + 1 / c_n)) as se from (
    select *, (conversions + c_conv) / (sample_size + c_n) as q from both_groups)))"""

SAMPLES = DENSE + """,
unique_events as (select user_id, item_id, behavior_type, time, min(item_category) as item_category from dense group by 1, 2, 3, 4),
span as (select min(time)::date + 7 as s, max(time)::date - 3 as e from unique_events),
cutoffs as (
  select s + greatest(1, floor(greatest(e - s, 3) * 0.7::double)::int) as train,
         least(s + greatest(2, floor(greatest(e - s, 3) * 0.8999999999999999::double)::int), e - 1) as val, e as test from span),
each_cut as (select 'train' as split, train as cut from cutoffs union all select 'val', val from cutoffs
             union all select 'test', test from cutoffs),
candidates as (select distinct split, cut, user_id, item_id, item_category from unique_events, each_cut
               where time >= cut - 7 and time < cut),
bought as (select distinct split, user_id, item_id from unique_events, each_cut
           where time >= cut and time < cut + 3 and behavior_type = 4),
pair_labels as (select c.*, cast(b.user_id is not null as int) as label
                from candidates c left join bought b using (split, user_id, item_id)),
ordered as (
  select *, sum(label) over (partition by split) as p,
         row_number() over (partition by split, label order by md5(concat_ws('|', user_id, item_id, item_category, '42'))) as r
  from pair_labels),
drawn as (select user_id, item_id, item_category, label, cut as cutoff_time, split from ordered
          where label = 1 or p = 0 or r <= 3 * p)"""


def _metrics(source: str, by: str, score: str) -> str:
    """Grouped metrics of a source with ``label``; AUC from cumulated negatives."""
    return f"""hist as (select {by}, {score} as s, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n
           from {source} group by 1, 2),
below as (select *, coalesce(sum(n) over (partition by {by} order by s rows between unbounded preceding and 1 preceding), 0) as nb from hist),
sums as (
  select {by}, sum(p)::bigint as p, sum(n)::bigint as n, coalesce(sum(p) filter (s >= 0.5), 0)::bigint as tp,
         coalesce(sum(n) filter (s >= 0.5), 0)::bigint as fp, sum(p * (nb + n / 2)) as u from below group by 1),
scores as (
  select {by}, p + n as sample_count, p / (p + n) as positive_rate, u::double / (p::double * n) as auc,
         (tp + n - fp) / (p + n) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as "precision",
         coalesce(tp / nullif(p, 0), 0) as recall, coalesce(2 * tp / nullif(tp + fp + p, 0), 0) as f1,
         (p - tp + fp) / (p + n) as error_rate from sums)"""


SCORES = ("auc", "accuracy", "precision", "recall", "f1")


def _sql(ctes: str, select: str, *rounded: str) -> str:
    text = f"with {ctes} {select}" if ctes else select
    if not rounded:
        return text
    replaced = ", ".join(f'round("{c}"::double, 6) + 0.0 as "{c}"' for c in rounded)
    return f"select * replace ({replaced}) from ({text})"


def _split() -> str:
    return LABELLED + """,
placed as (select *, count(*) over (partition by label) as n,
                  row_number() over (partition by label order by md5(concat_ws('|', user_id, '42'))) as r from labelled),
split as (select * exclude (n, r), case when r <= floor(n * 70 / 100) then 'train'
                when r <= floor(n * 90 / 100) then 'valid' else 'test' end as split from placed)"""


COMPARED = PRED + """,
long as (
  select label, 'Logistic Regression' as model, logistic_prob as s from pairs
  union all select label, 'XGBoost', xgboost_prob from pairs union all select label, 'DIN', din_prob from pairs
  union all select label, 'Stacking', stacking_prob from pairs),
""" + _metrics("long", "model", "s")

FLAGGED = PRED + """,
user_counts as (select user_id, count(*) as un from pred group by 1),
item_counts as (select item_id, count(*) as inn from pred group by 1),
flagged as (
  select p.*, un <= 30 as cold_start_user, inn <= (select quantile_cont(inn, 0.2) from item_counts) as long_tail_item
  from pred p join user_counts using (user_id) join item_counts using (item_id))"""

ORACLES: dict[str, str] = {
    # sources
    "scan_parquet": _sql("", "select * from events", "value"),
    "scan_columns": "select l_orderkey, l_partkey, l_shipdate from lineitem",
    "publish_star_schema": _sql(DENSE, """
        select 'dim_user' as name, count(distinct user_id) as n from dense
        union all select 'dim_item', count(*) from (select distinct item_id, item_category from dense)
        union all select 'dim_time', count(distinct time) from dense
        union all select 'fact_user_behavior', count(*) from dense"""),
    "query_sql": _sql(SPARSE, """
        select i.item_category, f.behavior_type, count(*) as n, count(distinct f.user_id) as users
        from sparse f join (select distinct item_id, item_category from sparse) i on f.item_id = i.item_id group by 1, 2"""),
    # quality
    "profile_shape": _sql(GAPS, """
        select 'row_count' as "column", count(*) as null_count from gaps
        union all select 'event_id', count(*) filter (event_id is null) from gaps
        union all select 'user_id', count(*) filter (user_id is null) from gaps
        union all select 'item_id', count(*) filter (item_id is null) from gaps
        union all select 'item_category', count(*) filter (item_category is null) from gaps
        union all select 'behavior_type', count(*) filter (behavior_type is null) from gaps
        union all select 'time', count(*) filter (time is null) from gaps"""),
    "invalid_id_counts": _sql(DENSE, """
        select count(*) filter (user_id <= 0) as invalid_user_id, count(*) filter (item_id <= 0) as invalid_item_id,
               count(*) filter (item_category <= 0) as invalid_item_category from dense"""),
    "duplicate_count": _sql(SPARSE, """
        select (select count(*) from sparse) - (select count(*) from (
          select distinct user_id, item_id, behavior_type, time from sparse)) as duplicate_count"""),
    "time_range": _sql(GAPS, """
        select count(*) filter (time is null) as invalid_time_count, min(time) as min_time, max(time) as max_time from gaps"""),
    "invalid_behavior_count": _sql(DENSE, """
        select count(*) filter (behavior_type not in (1, 2, 3, 4)) as invalid_behavior_count from dense"""),
    "quality_report": _sql(GAPS, """
        select 'completeness' as section, 'user_id' as metric, (count(*) filter (user_id is null))::varchar as value from gaps
        union all select 'completeness', 'item_id', (count(*) filter (item_id is null))::varchar from gaps
        union all select 'completeness', 'behavior_type', (count(*) filter (behavior_type is null))::varchar from gaps
        union all select 'completeness', 'time', (count(*) filter (time is null))::varchar from gaps
        union all select 'completeness', 'item_category', (count(*) filter (item_category is null))::varchar from gaps
        union all select 'consistency', 'invalid_behavior_count', (count(*) filter (behavior_type is null))::varchar from gaps
        union all select 'time', 'invalid_time_count', (count(*) filter (time is null))::varchar from gaps
        union all select 'time', 'min_time', strftime(min(time), '%Y-%m-%d %H:%M:%S') from gaps
        union all select 'time', 'max_time', strftime(max(time), '%Y-%m-%d %H:%M:%S') from gaps
        union all select 'uniqueness', 'duplicate_count', ((select count(*) from gaps) - (select count(*) from (
          select distinct user_id, item_id, behavior_type, time from gaps)))::varchar"""),
    "reconcile_mart": _sql(DENSE + """,
        m as (select user_id, item_id, count(*) as n, count(*) filter (behavior_type = 4) as b, max(time) as t
              from dense where behavior_type in (1, 2, 3, 4) group by 1, 2),
        f as (select user_id, item_id, count(*) as n, count(*) filter (behavior_type = 4) as b, max(time) as t
              from dense group by 1, 2)""", """
        select f.user_id, f.item_id, m.n as mart_action_count, f.n as fact_action_count, m.b as mart_buy_count,
               f.b as fact_buy_count, m.t as mart_last_time, f.t as fact_last_time
        from f left join m using (user_id, item_id)
        where m.n is distinct from f.n or m.b is distinct from f.b or m.t is distinct from f.t"""),
    "missing_rate": _sql(LIFECYCLE, " union all ".join(
        f"""select '{c}' as "column", avg(("{c}" is null)::int) as missing_rate from lifecycle""" for c in LIFECYCLE_COLUMNS), "missing_rate"),
    "unique_count": _sql(LIFECYCLE, " union all ".join(
        f"""select '{c}' as "column", count(distinct "{c}") + max(("{c}" is null)::int)::bigint as unique_count from lifecycle"""
        for c in LIFECYCLE_COLUMNS)),
    "duplicate_users": _sql(SPARSE, "select count(*) - count(distinct user_id) as duplicate_users from sparse"),
    # cleaning
    "dedup_events": _sql(SPARSE, """
        select user_id, item_id, min(item_category) as item_category, behavior_type, time from sparse group by 1, 2, 4, 5"""),
    "dedup_rows": _sql(SPARSE, "select distinct * from sparse"),
    "drop_nulls": _sql(GAPS, "select * from gaps where behavior_type is not null and time is not null"),
    "parse_time": "select event_id, ts as time from events where event_type <> 'error'",
    "coerce_numeric": _sql("", "select event_id, case when event_type <> 'error' then value end as value from events", "value"),
    "fill_missing": _sql(LIFECYCLE, """
        select * replace (coalesce(recent_30_behavior_count, 0) as recent_30_behavior_count,
                          coalesce(short_term_active_level, 'unknown') as short_term_active_level) from lifecycle"""),
    "replace_inf": _sql("", """
        select event_id, case when event_type in ('error', 'click', 'signup') then 0.0 else value end as value from events""", "value"),
    "impute_train_median": _sql(_split() + """,
        sparse_rates as (select user_id, label, nullif(fav_count, 0) as fav_count, nullif(buy_to_pv_rate, 0) as buy_to_pv_rate, split from split),
        medians as (select median(fav_count) as f, median(buy_to_pv_rate) as b from sparse_rates where split = 'train')""", """
        select user_id, label, coalesce(fav_count, f)::double as fav_count, coalesce(buy_to_pv_rate, b) as buy_to_pv_rate, split
        from sparse_rates, medians""", "fav_count", "buy_to_pv_rate"),
    "clip": _sql(PRED, """
        select user_id, item_id, least(greatest(logistic_prob, 0.05), 0.95) as logistic_prob,
               least(greatest(xgboost_prob, 0.05), 0.95) as xgboost_prob from pred""", "logistic_prob", "xgboost_prob"),
    "drop_constant_columns": _sql(SPARSE + ", " + TIME_FEATURES.format(view="sparse"), """
        select user_id, total_behavior_count, peak_hour_behavior_count, peak_period_behavior_count, night_behavior_count from time_features"""),
    "feature_quality_summary": _sql(LIFECYCLE + """,
        low as (""" + " union all ".join(
            f"select {i} as i, '{c}' as c, count(distinct {c}) + max(({c} is null)::int) <= 1 as is_low from lifecycle"
            for i, c in enumerate(LIFECYCLE_COLUMNS)) + ")", """
        select count(*) as wide_rows, 8 as wide_columns, count(*) - count(distinct user_id) as duplicate_users, 0 as duplicate_columns,
               (select count(*) from low where is_low)::int as low_variance_count,
               coalesce((select string_agg(c, ',' order by i) from low where is_low), '') as low_variance_features,
               count(*) as cleaned_rows, (8 - (select count(*) from low where is_low))::int as cleaned_columns, 0::bigint as nulls_left from lifecycle"""),
    # projections
    "with_time_parts": _sql(DENSE, """
        select event_id, time::date as date, hour(time)::int as hour, (isodow(time) - 1)::int as weekday, month(time)::int as month from dense"""),
    "with_behavior_flags": _sql(DENSE, """
        select event_id, (behavior_type = 1)::int as is_browse, (behavior_type = 2)::int as is_fav,
               (behavior_type = 3)::int as is_cart, (behavior_type = 4)::int as is_buy from dense"""),
    "with_time_period": _sql(DENSE, f"select event_id, {PERIOD} as time_period from dense"),
    "with_is_night": _sql(DENSE, "select event_id, (hour(time) >= 18 or hour(time) < 6)::int as is_night from dense"),
    "behavior_weight_implicit": _sql(DENSE, "select event_id, behavior_type::double as behavior_score from dense where behavior_type between 1 and 4"),
    "behavior_weight_value": _sql(DENSE, """
        select event_id, case behavior_type when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 5 end::int as behavior_score from dense"""),
    "active_level": _sql(DENSE, """
        select user_id, count(*) as n, case when count(*) >= 100 then '短期高活跃用户' when count(*) >= 30 then '短期中活跃用户'
               else '短期低活跃用户' end as level from dense group by 1"""),
    "with_day_type": _sql(DENSE, "select event_id, case when isodow(time) >= 6 then 'Weekend' else 'Weekday' end as day_type from dense"),
    "week_label_period": _sql(SPARSE, """
        select distinct time, concat(date_trunc('week', time)::date::varchar, '/', (date_trunc('week', time)::date + 6)::varchar) as week from sparse"""),
    "week_label_yw": _sql(SPARSE, "select distinct time, strftime(time, '%Y-%W') as week from sparse"),
    "safe_ratio": _sql(DENSE, """
        select user_id, item_id, coalesce(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 0) as ratio
        from dense group by 1, 2""", "ratio"),
    "date_window": _sql(DENSE, "select event_id, time from dense where time::date >= (select max(time)::date - 7 from dense)"),
    "normalize_text_key": """
        select p_partkey, replace(replace(lower(trim(concat(' ', p_type, '-', p_name))), ' ', '_'), '-', '_') as key from part""",
    "round_ratio": _sql(DENSE, """
        select user_id, item_id, coalesce(round(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 4), 0) as ratio
        from dense group by 1, 2""", "ratio"),
    # joins
    "left_join_user": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense") + """,
        recent as (select * from dense where time::date >= (select max(time)::date - 1 from dense)),
        """ + FUNNEL.format(view="recent") + """,
        dates as (select distinct user_id, time::date as date from dense),
        streaks as (select user_id, max(c) as s from (select user_id, g, count(*) as c from (
          select user_id, date - cast(row_number() over (partition by user_id order by date) as int) as g from dates) group by 1, 2) group by 1)""", """
        select t.user_id, t.peak_active_period, t.peak_period_behavior_count, t.peak_period_behavior_ratio,
               s.s as max_continuous_active_days, f.* exclude (user_id)
        from time_features t left join streaks s using (user_id) left join funnel f using (user_id)""", "peak_period_behavior_ratio", *RATES),
    "left_join_item": _sql(SPARSE + """,
        firsts as (select item_id, arg_min(item_category, time) as item_category, count(*) as item_action_count from (
          select * from sparse order by time, item_category) group by 1),
        recent as (select item_id, count(*) as recent from sparse where time::date >= (select max(time)::date - 30 from sparse) group by 1),
        cats as (select item_category, count(distinct item_id) as item_count from sparse group by 1)""", """
        select f.item_id, f.item_category, f.item_action_count, r.recent, c.item_count
        from firsts f left join recent r using (item_id) left join cats c using (item_category)"""),
    "total_by_group_join": _sql(DENSE + ", hours as (select user_id, hour(time)::int as hour, count(*) as n from dense group by 1, 2)", """
        select *, (sum(n) over (partition by user_id))::bigint as total from hours"""),
    "fact_dim_join": _sql(SPARSE, """
        select i.item_category, count(*) as behavior_count from sparse f
        join (select distinct item_id, item_category from sparse) i using (item_id) group by 1"""),
    "segment_inner_join": _sql(DENSE + ", " + SEGMENTS.format(view="dense"), """
        select d.user_id, count(*) filter (behavior_type = 1) as view_count, count(*) filter (behavior_type = 2) as favorite_count,
               count(*) filter (behavior_type = 3) as cart_count, count(*) filter (behavior_type = 4) as buy_count, s.segment
        from dense d join segments s using (user_id) group by d.user_id, s.segment"""),
    "semi_join_users": _sql(LABELLED, "select f.* from funnel f where user_id in (select user_id from label_buyers)", *RATES),
    "label_pair_join": _sql(SPARSE, "select user_id, item_id, max((behavior_type = 4)::int) as label from sparse group by 1, 2"),
    "align_predictions": _sql(PRED, """
        select user_id, item_id, label, least(greatest(logistic_prob, 1e-6), 1 - 1e-6) as logistic_prob,
               least(greatest(xgboost_prob, 1e-6), 1 - 1e-6) as xgboost_prob, least(greatest(din_prob, 1e-6), 1 - 1e-6) as din_prob
        from pairs where xgboost_prob > 0.2::double and din_prob < 0.8::double""", "logistic_prob", "xgboost_prob", "din_prob"),
    "attach_features": _sql(PRED + ", " + SPARSE + """,
        firsts as (select * from (select user_id, behavior_type as code, item_category as category,
          row_number() over (partition by user_id order by behavior_type, item_category) as r from sparse) where r = 1)""", """
        select p.user_id, p.item_id, p.logistic_prob, f.code, f.category from pairs p left join firsts f using (user_id)""", "logistic_prob"),
    "lookup_join": _sql(DENSE, """
        select event_id, nullif(behavior_type, 0) as behavior_type, count(*) over (partition by behavior_type) as n from dense"""),
    "repurchase_left_join": _sql(DENSE + ", p as (select user_id, item_id, count(*) as n from dense where behavior_type = 4 group by 1, 2)", """
        select item_id, count(*) as total_buyers, count(*) filter (n > 1) as repeat_buyers,
               round(count(*) filter (n > 1) / count(*), 4) as repurchase_rate from p group by 1""", "repurchase_rate"),
    # marts and reports
    "user_table": _sql(SPARSE, """
        select user_id, count(*) as action_count, count(*) filter (behavior_type = 1) as browse_count,
               count(*) filter (behavior_type = 2) as fav_count, count(*) filter (behavior_type = 3) as cart_count,
               count(*) filter (behavior_type = 4) as buy_count, count(distinct time::date) as active_days,
               min(time) as first_active_time, max(time) as last_active_time, count(distinct item_id) as unique_item_count,
               count(distinct item_category) as unique_category_count, count(*) filter (behavior_type = 4) / count(*) as conversion_rate
        from sparse group by 1""", "conversion_rate"),
    "item_table": _sql(SPARSE, """
        select item_id, count(*) as item_action_count, count(*) filter (behavior_type = 1) as item_browse_count,
               count(*) filter (behavior_type = 2) as item_fav_count, count(*) filter (behavior_type = 3) as item_cart_count,
               count(*) filter (behavior_type = 4) as item_buy_count, count(distinct user_id) as buyer_count,
               count(distinct time::date) as item_active_days, min(item_category) as item_category,
               count(*) filter (behavior_type = 4) / count(*) as item_conversion_rate from sparse group by 1""", "item_conversion_rate"),
    "time_table": _sql(SPARSE, """
        select time::date as date, count(*) as daily_action_count, count(*) filter (behavior_type = 1) as daily_browse_count,
               count(*) filter (behavior_type = 2) as daily_fav_count, count(*) filter (behavior_type = 3) as daily_cart_count,
               count(*) filter (behavior_type = 4) as daily_buy_count, count(distinct user_id) as active_user_count,
               count(distinct item_id) as active_item_count, count(*) filter (behavior_type = 4) / count(*) as daily_conversion_rate
        from sparse group by 1""", "daily_conversion_rate"),
    "category_table": _sql(SPARSE, """
        select item_category, count(*) filter (behavior_type = 1) as pv_count, count(*) filter (behavior_type = 2) as fav_count,
               count(*) filter (behavior_type = 3) as cart_count, count(*) filter (behavior_type = 4) as buy_count,
               count(distinct item_id) as item_count, count(distinct user_id) as user_count,
               count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0) as conversion_rate
        from sparse group by 1""", "conversion_rate"),
    "user_item_table": _sql(SPARSE, """
        select user_id, item_id, count(*) filter (behavior_type = 1) as ui_pv_count, count(*) filter (behavior_type = 2) as ui_fav_count,
               count(*) filter (behavior_type = 3) as ui_cart_count, count(*) filter (behavior_type = 4) as ui_buy_count,
               max(time) as last_behavior_time from sparse group by 1, 2"""),
    "star_schema": _sql(SPARSE, """
        select distinct time, time::date as date, hour(time)::int as hour, (isodow(time) - 1)::int as weekday, month(time)::int as month from sparse"""),
    "star_users": _sql(SPARSE, "select distinct user_id from sparse"),
    "star_items": _sql(SPARSE, "select distinct item_id, item_category from sparse"),
    "star_fact": _sql(SPARSE, "select time, user_id, item_id, behavior_type from sparse"),
    "downcast": _sql(DENSE, """
        select * replace (user_id::int as user_id, item_id::int as item_id, item_category::int as item_category, behavior_type::tinyint as behavior_type)
        from dense"""),
    "union_optional": _sql(DENSE, """
        select user_id, null::int as item_id, count(*) as n, null::timestamp as latest from dense group by 1
        union all select null, item_id, count(*), max(time) from dense group by 2"""),
    "require_domain": _sql(PRED, "select user_id, item_id, label, xgboost_prob as score from pred", "score"),
    "drop_columns_by_pattern": _sql(PRED, "select user_id, item_id, item_category, price from pred", "price"),
    "experiment_significance": _sql(ASSIGNED, """
        select z_value, p_value, p_value < 0.05 as statistically_significant from (
          select z_value, 2 * (0.5 - exp(-x * x / 2) / sqrt(2 * pi()) * series) as p_value from (
            select z_value, abs(z_value) as x, (
              select sum(exp((2 * k + 1) * ln(greatest(abs(z_value), 1e-300)) - logs)) from (
                select k, sum(ln(2 * k + 1)) over (order by k) as logs from range(200) as r(k))) as series from z))""", "z_value", "p_value"),
    "total_behavior_count": _sql(SPARSE, "select count(*) as total_behavior_count from sparse"),
    "behavior_count": _sql(SPARSE, "select behavior_type, count(*) as behavior_count from sparse group by 1"),
    "behavior_ratio": _sql(SPARSE, """
        select behavior_type, count(*) as behavior_count, round(count(*) / (select count(*) from sparse), 4) as ratio from sparse group by 1""", "ratio"),
    "daily_active_users": _sql(DENSE, "select time::date as date, count(distinct user_id) as daily_active_users from dense group by 1"),
    "weekly_active_users": _sql(SPARSE, "select strftime(time, '%Y-%W') as week, count(distinct user_id) as weekly_active_users from sparse group by 1"),
    "weekly_active_users_period": _sql(SPARSE, """
        select concat(date_trunc('week', time)::date::varchar, '/', (date_trunc('week', time)::date + 6)::varchar) as week,
               count(distinct user_id) as weekly_active_users from sparse group by 1"""),
    "hot_items_top10": _sql(SPARSE, "select item_id, count(*) as behavior_count from sparse group by 1 order by 2 desc, 1 limit 10"),
    "hot_categories_top10": _sql(SPARSE, """
        select i.item_category, count(*) as behavior_count from sparse f
        join (select distinct item_id, item_category from sparse) i using (item_id) group by 1 order by 2 desc, 1 limit 10"""),
    "funnel_users": _sql(SPARSE, "select behavior_type, count(distinct user_id) as user_count from sparse group by 1"),
    "user_group": _sql(SPARSE, """
        select case when n < 10 then '低活跃用户' when n between 10 and 50 then '中活跃用户' else '高活跃用户' end as user_group, count(*) as user_count
        from (select user_id, count(*) as n from sparse group by 1) group by 1"""),
    "repurchase_rate_top10": _sql(DENSE + ", p as (select user_id, item_id, count(*) as n from dense where behavior_type = 4 group by 1, 2)", """
        select item_id, count(*) as total_buyers, count(*) filter (n > 1) as repeat_buyers,
               round(count(*) filter (n > 1) / count(*), 4) as repurchase_rate from p group by 1 order by 4 desc, 1 limit 10""", "repurchase_rate"),
    "hour_distribution": _sql(DENSE, "select hour(time)::int as hour, count(*) as behavior_count from dense group by 1"),
    "hour_conversion_rate": _sql(DENSE, """
        select hour(time)::int as hour, count(*) filter (behavior_type = 1) as view, count(*) filter (behavior_type = 4) as buy,
               coalesce(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 0) as conversion_rate
        from dense where behavior_type in (1, 4) group by 1""", "conversion_rate"),
    "conversion_funnel": _sql(SPARSE + ", " + STAGES, """
        select 'View' as stage, v as users, null::double as step_rate from users union all select 'Favorite', f, f / v from users
        union all select 'Cart', c, c / f from users union all select 'Buy', b, b / c from users""", "step_rate"),
    "drop_rate": _sql(SPARSE + ", " + STAGES, "select * from marked", "drop_rate"),
    "rfm_buyers": _sql(SPARSE + ", " + SEGMENTS.format(view="sparse"), "select user_id, recency, frequency, frequency as monetary from buyers"),
    "rfm_segment": _sql(SPARSE + ", " + SEGMENTS.format(view="sparse"), "select * from segments"),
    "segment_count": _sql(SPARSE + ", " + SEGMENTS.format(view="sparse"), "select segment, count(*) as user_count from segments group by 1"),
    "segment_behavior": _sql(SPARSE + ", " + SEGMENTS.format(view="sparse"), """
        select segment, count(*) filter (behavior_type = 1) as view_count, count(*) filter (behavior_type = 2) as favorite_count,
               count(*) filter (behavior_type = 3) as cart_count, count(*) filter (behavior_type = 4) as buy_count,
               coalesce(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 0) as conversion_rate
        from sparse join segments using (user_id) group by 1""", "conversion_rate"),
    "category_conversion_rate": _sql(SPARSE, """
        select item_category, count(*) filter (behavior_type = 1) as view_count, count(*) filter (behavior_type = 4) as buy_count,
               coalesce(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 0) as conversion_rate
        from sparse where behavior_type in (1, 4) group by 1""", "conversion_rate"),
    "repurchase_overall": _sql(DENSE + ", p as (select user_id, item_id, count(*) as n from dense where behavior_type = 4 group by 1, 2)", """
        select count(*) as pair_count, count(*) filter (n > 1) as repeat_pair_count, count(*) filter (n > 1) / count(*) as repurchase_rate from p""",
        "repurchase_rate"),
    "top_repurchased_items": _sql(DENSE + ", p as (select user_id, item_id, count(*) as n from dense where behavior_type = 4 group by 1, 2)", """
        select item_id, count(*) as repeat_users from p where n > 1 group by 1 order by 2 desc, 1 limit 20"""),
    "day_type_behavior": _sql(SPARSE, """
        select case when isodow(time) >= 6 then 'Weekend' else 'Weekday' end as day_type, count(*) filter (behavior_type = 1) as view,
               count(*) filter (behavior_type = 2) as favorite, count(*) filter (behavior_type = 3) as cart, count(*) filter (behavior_type = 4) as buy,
               coalesce(count(*) filter (behavior_type = 4) / nullif(count(*) filter (behavior_type = 1), 0), 0) as conversion_rate
        from sparse group by 1""", "conversion_rate"),
    "eda_summary": _sql(SPARSE + ", " + STAGES + ", p as (select user_id, item_id, count(*) as n from sparse where behavior_type = 4 group by 1, 2)", """
        select count(*) as row_count, count(distinct user_id) as user_count, count(distinct item_id) as item_count,
               count(distinct item_category) as category_count, min(time)::date as first_date, max(time)::date as last_date,
               (select v from users) as view_users, (select f from users) as favorite_users, (select c from users) as cart_users,
               (select b from users) as buy_users, (select b / v from users) as view_to_buy_rate,
               (select count(*) filter (n > 1) / count(*) from p) as repurchase_rate,
               (select step from marked where is_largest) as largest_drop from sparse""", "view_to_buy_rate", "repurchase_rate"),
    "label_distribution": _sql(LABELLED, "select label, count(*) as n, count(*) / (select count(*) from labelled) as share from labelled group by 1", "share"),
    "pivot_counts": _sql(DENSE + ", " + FUNNEL.format(view="dense"), "select user_id, pv_count, fav_count, cart_count, buy_count from funnel"),
    # order and ranks
    "peak_hour": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense"), """
        select user_id, peak_active_hour, peak_hour_behavior_count, peak_hour_behavior_ratio from time_features""", "peak_hour_behavior_ratio"),
    "peak_period": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense"), """
        select user_id, peak_active_period, peak_period_behavior_count, peak_period_behavior_ratio from time_features""", "peak_period_behavior_ratio"),
    "previous_event": _sql(DENSE + ", " + LAGGED.format(view="dense"), "select event_id, previous_time, previous_behavior_type from lagged"),
    "same_behavior_as_previous": _sql(DENSE + ", " + LAGGED.format(view="dense"), """
        select event_id, coalesce(behavior_type = previous_behavior_type, false)::int as is_same_behavior from lagged"""),
    "max_active_streak": _sql(DENSE + ", dates as (select distinct user_id, time::date as date from dense)", """
        select user_id, max(c) as max_continuous_active_days from (select user_id, g, count(*) as c from (
          select user_id, date - cast(row_number() over (partition by user_id order by date) as int) as g from dates) group by 1, 2) group by 1"""),
    "last_n_sequence": _sql(DENSE + """,
        u as (select user_id, item_id, behavior_type, time, min(item_category) as item_category from dense group by 1, 2, 3, 4),
        k as (select *, row_number() over (partition by user_id order by time desc, item_id desc, behavior_type desc) as r from u)""", """
        select user_id, string_agg(item_id, ',' order by r desc) as item_seq, string_agg(item_category, ',' order by r desc) as cate_seq,
               string_agg(behavior_type, ',' order by r desc) as behavior_seq from k where r <= 50 group by 1"""),
    "rank_first": _sql(SPARSE + ", c as (select user_id, count(*) as n from sparse group by 1)", "select *, row_number() over (order by n, user_id) as rank from c"),
    "qcut_codes": _sql(SPARSE + ", c as (select user_id, count(*) as n from sparse group by 1), k as (select *, row_number() over (order by n, user_id) as rank from c)", """
        select *, greatest(ceil((rank - 1) * 5 / ((select count(*) from c) - 1))::bigint - 1, 0) as code from k"""),
    "qcut_values": _sql(PRED + """, u as (select user_id, avg(price) as score from pred group by 1),
        e as (select list(x order by x) as e from (select distinct unnest(quantile_cont(score,
          [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) as x from u))""", """
        select user_id, score, len(list_filter(e[2:len(e) - 1], lambda x: x < score)) as code from u, e""", "score"),
    "percent_rank_avg": _sql(SPARSE + ", c as (select item_id, count(*) as n from sparse group by 1)", """
        select *, (rank() over (order by n) + (count(*) over (partition by n) - 1) / 2) / (select count(*) from c) as percent_rank from c""", "percent_rank"),
    "cut_fixed": _sql(PRED, """
        select user_id, item_id, xgboost_prob as score, case when xgboost_prob <= 0.4::double then '低' when xgboost_prob <= 0.7::double then '中'
               else '高' end as level from pred""", "score"),
    "first_per_key": _sql(DENSE, """
        select event_id, user_id, item_id, time from (select *, row_number() over (partition by user_id order by time, event_id) as r from dense) where r = 1"""),
    # top-k, unions, draws
    "behavior_sequence": _sql(SPARSE, "select user_id, item_id, behavior_type, time from sparse order by user_id, time, item_id, behavior_type limit 100"),
    "top_items": _sql(DENSE, "select item_id, count(*) as behavior_count from dense group by 1 order by 2 desc, 1 limit 20"),
    "top_categories": _sql(SPARSE, "select item_category, count(*) as behavior_count from sparse group by 1 order by 2 desc, 1 limit 20"),
    "top_n_with_threshold": _sql(ASSIGNED, "select * from targets", "score", "price", "threshold"),
    "rank_models": _sql(COMPARED, """
        select model, auc, accuracy, "precision", recall, f1, row_number() over (order by auc desc, model)::int as rank from scores""", *SCORES),
    "union_frames": _sql(DENSE, """
        select user_id, item_id from dense where behavior_type = 1 union all select user_id, item_id from dense where behavior_type = 4"""),
    "sample_exact": _sql(SPARSE, """
        select user_id, item_id, count(*) filter (behavior_type = 1) as ui_pv_count, count(*) filter (behavior_type = 2) as ui_fav_count,
               count(*) filter (behavior_type = 3) as ui_cart_count, count(*) filter (behavior_type = 4) as ui_buy_count,
               max(time) as last_behavior_time from sparse group by 1, 2 order by md5(concat_ws('|', user_id, item_id, '42')) limit 1000"""),
    "sample_cap": _sql(DENSE, "select event_id, user_id, item_id from dense order by md5(concat_ws('|', event_id, '42')) limit 500"),
    "distinct_users": _sql(SPARSE, "select distinct user_id from sparse"),
    # features
    "time_features": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense"), "select * from time_features",
                          "peak_hour_behavior_ratio", "peak_period_behavior_ratio", "night_behavior_ratio"),
    "user_lifecycle_features": _sql(LIFECYCLE, "select * from lifecycle"),
    "item_lifecycle_features": _sql(SPARSE + """,
        i as (select item_id, count(*) as item_total_behavior_count,
                     count(*) filter (time::date >= (select max(time)::date - 7 from sparse)) as item_recent_7_behavior_count,
                     min(item_category) as item_category from sparse group by 1)""", """
        select *, item_recent_7_behavior_count / item_total_behavior_count as heat_decay_score,
               count(*) over (partition by item_category) as category_item_count,
               count(*) over (partition by item_category) as category_competition_degree from i""", "heat_decay_score"),
    "behavior_sequence_features": _sql(DENSE + ", " + SEQUENCE.format(view="dense"), "select * from sequence_features", "avg_behavior_interval_seconds"),
    "behavior_transition_matrix": _sql(DENSE + ", " + LAGGED.format(view="dense"), """
        select *, transition_count / previous_behavior_total as transition_probability from (
          select *, (sum(transition_count) over (partition by previous_behavior_type))::bigint as previous_behavior_total from (
            select previous_behavior_type, behavior_type, count(*) as transition_count from lagged
            where previous_behavior_type is not null group by 1, 2))""", "transition_probability"),
    "interaction_matrix": _sql(SPARSE, "select user_id, item_id, sum(behavior_type)::double as weight from sparse group by 1, 2"),
    "rfm_features": _sql(SPARSE + ", " + BUSINESS.format(view="sparse"), "select * from rfm_features"),
    "user_funnel": _sql(SPARSE + ", " + FUNNEL.format(view="sparse"), "select * from funnel", *RATES),
    "user_preference_score": _sql(DENSE + ", " + BUSINESS.format(view="dense"), "select user_id, behavior_value_score as user_preference_score from measures"),
    "business_features": _sql(DENSE + ", " + BUSINESS.format(view="dense"), "select * from business", *RATES),
    "feature_table": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense") + ", " + SEQUENCE.format(view="dense") + ", " + BUSINESS.format(view="dense"), """
        select t.*, s.* exclude (user_id), b.* exclude (user_id)
        from time_features t left join sequence_features s using (user_id) left join business b using (user_id)""",
        "peak_hour_behavior_ratio", "peak_period_behavior_ratio", "night_behavior_ratio", "avg_behavior_interval_seconds", *RATES),
    "feature_table_cleaned": _sql(LIFECYCLE + ", " + TIME_FEATURES.format(view="sparse"), """
        select l.* replace (coalesce(recent_30_behavior_count, 0) as recent_30_behavior_count,
                            coalesce(short_term_active_level, 'unknown') as short_term_active_level),
               t.peak_hour_behavior_count from lifecycle l left join time_features t using (user_id)"""),
    # model data
    "purchase_label": _sql(LABELLED + """, s as (select user_id, sum(case behavior_type when 4 then 5 else behavior_type end)::bigint as user_preference_score
        from sparse group by 1)""", """
        select s.*, cast(b.user_id is not null as int) as label from s left join label_buyers b using (user_id)"""),
    "history_filter": _sql(LABELLED, """
        select user_id, sum(case behavior_type when 4 then 5 else behavior_type end)::bigint as user_preference_score
        from sparse where user_id in (select user_id from history) group by 1"""),
    "undersample_balanced": _sql(LABELLED + """,
        placed as (select *, row_number() over (partition by label order by md5(concat_ws('|', user_id, '42'))) as r from labelled)""", """
        select * exclude (r) from placed where r <= (select min(n) from (select count(*) as n from labelled group by label))""", *RATES),
    "target_encode": _sql(DENSE + ", " + TIME_FEATURES.format(view="dense") + """,
        b as (select distinct user_id from dense where time::date > (select max(time)::date - 3 from dense) and behavior_type = 4),
        l as (select t.user_id, t.peak_active_period, cast(b.user_id is not null as int) as label from time_features t left join b using (user_id))""", """
        select *, avg(label) over (partition by peak_active_period) as peak_active_period_target_encoded from l""", "peak_active_period_target_encoded"),
    "standardize": _sql(LABELLED, "select user_id, " + ", ".join(
        f"coalesce(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 0) as {c}"
        for c in ("pv_count", "fav_count", "cart_count", "buy_count", *RATES)) + ", label from labelled",
        "pv_count", "fav_count", "cart_count", "buy_count", *RATES),
    "build_samples": _sql(SAMPLES, "select * from drawn where split = 'train'"),
    "choose_cutoffs": _sql(SPARSE + ", span as (select min(time)::date + 7 as s, max(time)::date - 3 as e from sparse)", """
        select s + greatest(1, floor(greatest(e - s, 3) * 0.7::double)::int) as train_cutoff,
               least(s + greatest(2, floor(greatest(e - s, 3) * 0.8999999999999999::double)::int), e - 1) as val_cutoff, e as test_cutoff from span"""),
    "build_time_split_dataset": _sql(SAMPLES, "select * from drawn"),
    "build_sequence_samples": _sql(SAMPLES + """,
        k as (select *, row_number() over (partition by split, user_id order by time desc, item_id desc, behavior_type desc) as r
              from unique_events, each_cut where time >= cut - 7 and time < cut),
        q as (select split, user_id, string_agg(item_id, ',' order by r desc) as item_seq, string_agg(item_category, ',' order by r desc) as cate_seq,
                     string_agg(behavior_type, ',' order by r desc) as behavior_seq from k where r <= 50 group by 1, 2)""", """
        select d.*, q.item_seq, q.cate_seq, q.behavior_seq from drawn d join q using (split, user_id)"""),
    "encode_ids": _sql(DENSE, """
        select event_id, dense_rank() over (order by user_id::varchar) as user_id_idx, dense_rank() over (order by item_id::varchar) as item_id_idx,
               dense_rank() over (order by item_category::varchar) as item_category_idx, dense_rank() over (order by behavior_type::varchar) as behavior_type_idx
        from dense"""),
    "pad_sequence": _sql(DENSE + ", d as (select user_id, list(distinct day(time)) as l from dense group by 1), s as (select user_id, list_sort(l) as l from d)", """
        select user_id, least(len(l), 20)::int as days_length,
               array_to_string(list_concat(list_transform(range(greatest(20 - len(l), 0)), lambda x: 0), l[greatest(len(l) - 19, 1):len(l)]), ',') as days from s"""),
    "stratified_split": _sql(_split(), "select user_id, label, split from split"),
    "smote_balance": _sql(LABELLED, """
        select label, (select max(n) from (select count(*) as n from labelled group by label)) as n from labelled group by label"""),
    "smote_kept_rows": _sql(LABELLED, "select " + ", ".join(f"{c}::double as {c}" for c in ("pv_count", "fav_count", "cart_count", "buy_count")) + ", "
                            + ", ".join(RATES) + ", label from labelled", *RATES),
    "class_weights": _sql(LABELLED, """
        select label as class, (select count(*) from labelled) / (count(*) * 2) as class_weight from labelled group by 1""", "class_weight"),
    "scale_pos_weight": _sql(LABELLED, "select count(*) filter (label = 0) / count(*) filter (label = 1) as scale_pos_weight from labelled", "scale_pos_weight"),
    "label_correlation": _sql(LABELLED, " union all ".join(
        f"select '{c}' as feature, abs(corr({c}, label)) as correlation from labelled"
        for c in ("pv_count", "fav_count", "cart_count", "buy_count", *RATES)), "correlation"),
    "dataset_summary": _sql(LABELLED, """
        select (select count(*) from labelled) as labelled_rows,
               (select 2 * min(n) from (select count(*) as n from labelled group by label)) as balanced_rows,
               max(time)::date - 180 as feature_end_date, max(time)::date as label_end_date from sparse"""),
    # models
    "evaluate_binary": _sql(PRED + ", " + _metrics("pred", "status", "xgboost_prob"), "select * from scores", "positive_rate", *SCORES, "error_rate"),
    "pr_auc": _sql(PRED + """,
        h as (select xgboost_prob as s, count(*) filter (label = 1) as p, count(*) as n from pred group by 1),
        c as (select s, sum(p) over w as tp, sum(n) over w as seen, (select sum(p) from h) as total from h window w as (order by s desc)),
        r as (select s, tp / total as recall, tp / seen as prec from c),
        g as (select recall - coalesce(lag(recall) over (order by s desc), 0) as step, (prec + coalesce(lag(prec) over (order by s desc), prec)) / 2 as height from r)""",
        "select sum(step * height) as pr_auc from g", "pr_auc"),
    "classification_report": _sql(PRED + """,
        c as (select count(*) filter (label = 0 and logistic_prob < 0.5) as tn, count(*) filter (label = 0 and logistic_prob >= 0.5) as fp,
                     count(*) filter (label = 1 and logistic_prob < 0.5) as fn, count(*) filter (label = 1 and logistic_prob >= 0.5) as tp from pred),
        r as (select '0' as class, tn / (tn + fn) as "precision", tn / (tn + fp) as recall, 2 * tn / (2 * tn + fn + fp) as f1, tn + fp as support from c
              union all select '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn from c)""", """
        select * from r union all select 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp from c
        union all select 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support)::bigint from r
        union all select 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
                         sum(f1 * support) / sum(support), sum(support)::bigint from r""", "precision", "recall", "f1"),
    "confusion_matrix": _sql(PRED, """
        select label, count(*) filter (logistic_prob < 0.5) as predicted_0, count(*) filter (logistic_prob >= 0.5) as predicted_1 from pred group by 1"""),
    "model_comparison": _sql(PRED + """,
        long as (select label, 'Logistic Regression' as model, logistic_prob as s from pred where status = 'O'
                 union all select label, 'XGBoost', xgboost_prob from pred where status = 'O'
                 union all select label, 'DIN', din_prob from pred where status = 'O'), """ + _metrics("long", "model", "s"), """
        select model, accuracy as "Accuracy", "precision" as "Precision", recall as "Recall", f1 as "F1", auc as "ROC_AUC",
               row_number() over (order by auc desc, model)::int as "Rank" from scores""", "Accuracy", "Precision", "Recall", "F1", "ROC_AUC"),
    "compare_base_and_stacking": _sql(COMPARED, 'select model, auc, accuracy, "precision", recall, f1 from scores', *SCORES),
    "standardize_predictions": _sql(PRED, "select user_id, item_id, label, xgboost_prob from pairs where xgboost_prob <= 0.9::double", "xgboost_prob"),
    # explanation
    "core_features": _sql(LABELLED + """,
        a as (""" + " union all ".join(
            f"select '{c}' as feature, 'XGBoost' as m, abs(corr({c}, label)) as v from labelled" for c in ("pv_count", "fav_count", "cart_count", "buy_count", *RATES))
        + " union all " + " union all ".join(
            f"select '{c}', 'Logistic Regression', avg({c}) from labelled" for c in ("pv_count", "fav_count", "cart_count", "buy_count")) + """),
        s as (select *, v / max(v) over (partition by m) as w from a)""", """
        select feature, avg(w) as mean_normalized_importance, max(w) as max_normalized_importance, count(distinct m) as model_count,
               string_agg(m, ',' order by m) as source_models from s group by 1""", "mean_normalized_importance", "max_normalized_importance"),
    "error_samples": _sql(PRED, """
        select user_id, item_id, label, stacking_prob, (stacking_prob >= 0.5)::int as stacking_prediction,
               case when label = 0 then '假阳性_FP' else '假阴性_FN' end as error_type, abs(label - stacking_prob) as absolute_error
        from pred where label <> (stacking_prob >= 0.5)::int""", "stacking_prob", "absolute_error"),
    "cold_start_flag": _sql(FLAGGED, "select user_id, item_id, cold_start_user from flagged"),
    "long_tail_flag": _sql(FLAGGED, "select user_id, item_id, long_tail_item from flagged"),
    "scenario_metrics": _sql(FLAGGED + """,
        cases as (select label, stacking_prob, '整体样本' as scenario from flagged
                  union all select label, stacking_prob, case when cold_start_user then '冷启动用户' else '非冷启动用户' end from flagged
                  union all select label, stacking_prob, case when long_tail_item then '长尾商品' else '非长尾商品' end from flagged), """
        + _metrics("cases", "scenario", "stacking_prob"), "select * from scores", "positive_rate", *SCORES, "error_rate"),
    # experiment
    "experiment_units": _sql(UNITS, "select * from units", "score", "price"),
    "target_population": _sql(UNITS + ", cut as (select quantile_cont(score, 0.8) as threshold from units)",
                              "select units.*, threshold from units, cut where score >= threshold", "score", "price", "threshold"),
    "stratified_assignment": _sql(ASSIGNED, "select * from assigned", "score", "price", "threshold"),
    "baseline_rate": _sql(ASSIGNED, "select * from base", "baseline_rate"),
    "required_sample_size": _sql(ASSIGNED, "select * from sizes", "baseline_rate"),
    "experiment_days": _sql(ASSIGNED, "select * from timed", "baseline_rate"),
    "group_metrics": _sql(ASSIGNED, "select * from group_metrics", "conversion_rate", "average_order_value", "revenue", "marketing_cost",
                          "variable_cost", "gross_profit"),
    "two_proportion_z_test": _sql(ASSIGNED, "select z_value from z", "z_value"),
    "effect_summary": _sql(ASSIGNED, """
        select c_rate as control_conversion_rate, conversion_rate as treatment_conversion_rate, conversion_rate - c_rate as absolute_lift,
               (conversion_rate - c_rate) / nullif(c_rate, 0) as relative_lift, z_value, required_sample_per_group,
               sample_size as actual_treatment_sample, c_n as actual_control_sample,
               sample_size >= required_sample_per_group and c_n >= required_sample_per_group as sample_size_sufficient,
               experiment_days as recommended_experiment_days, conversions - sample_size * c_rate as incremental_conversions,
               (conversions - sample_size * c_rate) * average_order_value as incremental_revenue,
               (conversions - sample_size * c_rate) * average_order_value * 0.7 - marketing_cost as incremental_profit,
               ((conversions - sample_size * c_rate) * average_order_value * 0.7 - marketing_cost) / marketing_cost as marketing_roi
        from z, timed""", "control_conversion_rate", "treatment_conversion_rate", "absolute_lift", "relative_lift", "z_value",
        "incremental_conversions", "incremental_revenue", "incremental_profit", "marketing_roi"),
    "score_segment_analysis": _sql(ASSIGNED + """,
        q as (select quantile_cont(score, [0.2, 0.4, 0.6, 0.8]) as q from assigned)""", """
        select ['低潜', '较低潜', '中潜', '较高潜', '高潜'][1 + len(list_filter(q, lambda x: x < score))] as score_segment, ab_group as "group",
               count(*) as sample_size, avg(score) as average_model_score, avg(label) as conversion_rate from assigned, q group by 1, 2""",
        "average_model_score", "conversion_rate"),
    "category_recommendations": _sql(ASSIGNED + """,
        c as (select item_category as category, count(*) as target_users, avg(score) as average_model_score, avg(label) as conversion_rate
              from assigned group by 1),
        k as (select *, (select count(*) from c) as n,
                     rank() over (order by average_model_score) + (count(*) over (partition by average_model_score) - 1) / 2 as rs,
                     rank() over (order by conversion_rate) + (count(*) over (partition by conversion_rate) - 1) / 2 as rc,
                     rank() over (order by target_users) + (count(*) over (partition by target_users) - 1) / 2 as ru from c),
        s as (select category, target_users, average_model_score, conversion_rate,
                     rs / n * 0.5::double + rc / n * 0.3::double + ru / n * 0.2::double as priority_score from k)""", """
        select *, case when priority_score <= 0.4::double then '低' when priority_score <= 0.7::double then '中' else '高' end as recommendation_priority
        from s""", "average_model_score", "conversion_rate", "priority_score"),
}
