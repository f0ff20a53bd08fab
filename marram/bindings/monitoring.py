"""Drift, quality, profiles and time windows on the event stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.bindings.registry import EVENT_SQL, LINES, PRICE_RULE_SQL, event_measurements, load, price_rule, query
from marram.bindings.requests import stream_table
from marram.operators import drift, profiles, timing
from marram.plans.monitor_store import MonitorStore
from marram.session import scratch_path
from marram.streaming.profile import daily_profile, read_daily_profile, stream_daily_profile

HALFWAY = "2024-01-16 00:00:00"


def is_current() -> Column:
    return F.col("ts") >= F.lit(HALFWAY).cast("timestamp_ntz")


IS_CURRENT_SQL = f"ts >= timestamp '{HALFWAY}'"
VALUE_EDGES = [25.0 * i for i in range(1, 10)]
K_EDGES = [20.0, 40.0, 60.0, 80.0]


@query("drift_psi_js", f"""
    with e as (select *, {IS_CURRENT_SQL} as cur from ({EVENT_SQL})),
    t as (select 'value' as feature, 10 as bins, least(cast(floor(value / 25) as integer), 9) as b, cur from e
          union all select 'k', 5, least(cast(floor(k / 20) as integer), 4), cur from e),
    g as (select feature, bins, b, count(*) filter (not cur) as nb, count(*) filter (cur) as nc from t group by 1, 2, 3),
    s as (select feature, bins, sum(nb) as tb, sum(nc) as tc from g group by 1, 2),
    a as (select s.feature, s.bins, tb, tc, u.b, coalesce(nb, 0) as nb, coalesce(nc, 0) as nc
          from s join unnest(range(10)) u(b) on u.b < s.bins
          left join g on g.feature = s.feature and g.b = u.b),
    f as (select feature, (nb + 0.5e0) / (tb + 0.5e0 * bins) as pb, (nc + 0.5e0) / (tc + 0.5e0 * bins) as pc from a)
    select feature, round(sum((pc - pb) * ln(pc / pb)), 9) as psi,
           round(sqrt(0.5e0 * sum(pb * ln(2 * pb / (pb + pc)) + pc * ln(2 * pc / (pb + pc)))), 9) as js_distance
    from f group by feature
""")
def drift_psi_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_measurements(load(spark, sf_dir, "events"))
    found = drift.binned_drift(rows, is_current(), {"value": VALUE_EDGES, "k": K_EDGES})
    return found.withColumns({c: F.round(c, 9) for c in ("psi", "js_distance")})


MONITOR_BOUNDS = {"value": (1.0, 200.0), "k": (5.0, 95.0)}


@query("monitor_daily", f"""
    with e as (select *, {IS_CURRENT_SQL} as cur, cast(ts - interval 195 minute as date) + 1 as monitor_day from ({EVENT_SQL})),
    t as (select monitor_day, 'value' as feature, 10 as bins, least(cast(floor(value / 25) as integer), 9) as b, value as v, cur,
                 value < 1 or value > 200 as outside from e
          union all select monitor_day, 'k', 5, least(cast(floor(k / 20) as integer), 4), k, cur, k < 5 or k > 95 from e),
    o as (select feature, b, count(v) as n from t where not cur group by all),
    d as (select monitor_day, feature, bins, count(*) as n_rows, count(*) - count(v) as n_missing, count(*) filter (outside) as n_outside,
                 avg(v) as mean, stddev_pop(v) as std, min(v) as low, max(v) as high from t where cur group by all),
    c as (select monitor_day, feature, b, count(v) as n from t where cur group by all),
    a as (select d.monitor_day, d.feature, d.bins, u.b, coalesce(o.n, 0) as nb, coalesce(c.n, 0) as nc
          from d join unnest(range(10)) u(b) on u.b < d.bins left join o on o.feature = d.feature and o.b = u.b
          left join c on c.monitor_day = d.monitor_day and c.feature = d.feature and c.b = u.b),
    f as (select *, (nb + 0.5e0) / (sum(nb) over w + 0.5e0 * bins) as pb, (nc + 0.5e0) / (sum(nc) over w + 0.5e0 * bins) as pc
          from a window w as (partition by monitor_day, feature)),
    m as (select monitor_day, feature, sum((pc - pb) * ln(pc / pb)) as psi,
                 sqrt(0.5e0 * sum(pb * ln(2 * pb / (pb + pc)) + pc * ln(2 * pc / (pb + pc)))) as js from f group by all)
    select strftime(monitor_day, '%Y-%m-%d') as monitor_day, feature, n_rows, n_missing, n_outside, round(mean, 9) as mean,
           round(std, 9) as std, low, high, round(psi, 9) as psi, round(js, 9) as js_distance
    from d join m using (monitor_day, feature)
""")
def monitor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later events arrive in three batches that each touch every day; one of them arrives twice. Earlier ones are the baseline."""
    rows = event_measurements(load(spark, sf_dir, "events"))
    store = MonitorStore(scratch_path(spark, "monitor_daily", sf_dir), {"value": VALUE_EDGES, "k": K_EDGES}, MONITOR_BOUNDS)
    store.set_baseline(rows.where(~is_current()))
    for batch in (0, 1, 2, 1):
        store.add(rows.where(is_current() & (F.col("event_id") % 3 == batch)), batch, "ts")
    found = store.report(spark).withColumn("monitor_day", F.col("monitor_day").cast("string"))
    rounded = {"mean": 9, "std": 9, "psi": 9, "js_distance": 9}
    return found.withColumns({c: F.round(c, digits) for c, digits in rounded.items()})


@query("drift_ks_w1", f"""
    with e as (select value as v, {IS_CURRENT_SQL} as cur from events),
    g as (select v, count(*) filter (not cur) as nb, count(*) filter (cur) as nc from e group by v),
    t as (select cast(sum(nb) as double) as tb, cast(sum(nc) as double) as tc from g),
    w as (select v, sum(nb) over (order by v) / tb as fb, sum(nc) over (order by v) / tc as fc, lead(v) over (order by v) as nv from g, t)
    select 'value' as feature, round(max(abs(fb - fc)), 9) as ks, round(sum(abs(fb - fc) * (nv - v)), 6) as wasserstein_1 from w
""")
def drift_ks_w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.exact_drift(load(spark, sf_dir, "events"), "value", is_current())
    return found.withColumns({"ks": F.round("ks", 9), "wasserstein_1": F.round("wasserstein_1", 6)})


@query("prediction_drift", f"""
    with g as (select {PRICE_RULE_SQL} as label, count(*) filter (o_orderdate < timestamp '1998-01-01') as nb,
                      count(*) filter (o_orderdate >= timestamp '1998-01-01') as nc from orders group by 1),
    s as (select nb / (sum(nb) over ()) as pb, nc / (sum(nc) over ()) as pc from g)
    select 'predicted' as feature, count(*) as labels, round(0.5e0 * sum(abs(pb - pc)), 9) as total_variation,
           round(sqrt(0.5e0 * sum(case when pb > 0 then pb * ln(2 * pb / (pb + pc)) else 0 end
                                  + case when pc > 0 then pc * ln(2 * pc / (pb + pc)) else 0 end)), 9) as js_distance
    from s
""")
def prediction_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.col("o_orderdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    judged = load(spark, sf_dir, "orders").select(price_rule().alias("predicted"), later.alias("later"))
    found = drift.categorical_drift(judged, "predicted", F.col("later"))
    return found.withColumns({c: F.round(c, 9) for c in ("total_variation", "js_distance")})


@query("data_quality", f"""
    with e as ({EVENT_SQL}),
    b as (select min(value) as vlo, max(value) as vhi, min(k) as klo, max(k) as khi from e where not ({IS_CURRENT_SQL})),
    t as (select event_type, 'value' as feature, case when event_id % 13 = 0 then null when event_id % 17 = 0 then 'n/a'
                    when event_id % 19 = 0 then cast(value * 1000 as varchar) else cast(value as varchar) end as x, vlo as lo, vhi as hi
          from e, b where {IS_CURRENT_SQL}
          union all
          select event_type, 'k', case when event_id % 23 = 0 then null else cast(k as varchar) end, klo, khi from e, b where {IS_CURRENT_SQL}),
    n as (select event_type, feature, count(*) as n, count(*) filter (x is null) as nulls,
                 count(*) filter (x is not null and try_cast(x as double) is null) as type_errors,
                 count(*) filter (try_cast(x as double) < lo or try_cast(x as double) > hi) as out_of_bounds
          from t group by 1, 2)
    select *, round(nulls / n, 9) as null_rate, round(type_errors / n, 9) as type_error_rate,
           round(out_of_bounds / n, 9) as out_of_bounds_rate from n
""")
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_measurements(load(spark, sf_dir, "events"))
    bounds = profiles.value_bounds(rows.where(~is_current()), ["value", "k"])
    key = F.col("event_id")
    value = (
        F.when(key % 13 == 0, F.lit(None)).when(key % 17 == 0, F.lit("n/a"))
        .when(key % 19 == 0, (F.col("value") * 1000).cast("string")).otherwise(F.col("value").cast("string"))
    )
    k = F.when(key % 23 != 0, F.col("k").cast("string"))
    text = rows.where(is_current()).select("event_type", value.alias("value"), k.alias("k"))
    found = profiles.data_quality(text, ["value", "k"], bounds, group=["event_type"])
    return found.withColumns({c: F.round(c, 9) for c in ("null_rate", "type_error_rate", "out_of_bounds_rate")})


def _quantile_sql(column: str, name: str) -> str:
    picks = ", ".join(f"min(v) filter (upto >= {p}e0 * n) + 0e0 as q{round(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""
    select '{name}' as feature, (select count({column}) from lineitem) as n,
           (select round(avg({column}), 6) from lineitem) as mean, (select round(stddev_pop({column}), 6) from lineitem) as std,
           (select min({column}) + 0e0 from lineitem) as min, (select max({column}) + 0e0 from lineitem) as max, {picks}
    from (select v, sum(c) over (order by v) as upto, sum(c) over () as n
          from (select {column} as v, count(*) as c from lineitem where {column} is not null group by 1))
    """


@query("feature_profile", " union all ".join(
    _quantile_sql(column, name) for column, name in LINES.rename.items() if name in LINES.features))
def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = LINES.canonical(load(spark, sf_dir, "lineitem"))
    found = profiles.feature_profile(lines, LINES.features)
    # A zero may come with either sign; adding zero settles it on both sides of the comparison.
    plain = {c: F.col(c) + F.lit(0.0) for c in ("min", "max", "q25", "q50", "q75")}
    return found.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6), **plain})


DAILY_SQL = """
    select strftime(date_trunc('day', ts - interval '195' minute) + interval '195' minute, '%Y-%m-%d %H:%M:%S') as window_start,
           event_type, count(*) as n, round(sum(value), 4) as total
"""


@query("daily_windows", DAILY_SQL + "from events group by 1, 2")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = timing.daily_counts(load(spark, sf_dir, "events"), "ts", ["event_type"], total=F.sum("value"))
    return daily.withColumns({"window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
                              "total": F.round("total", 4)})


@query("stream_daily_profile", DAILY_SQL + ", min(value) as low, max(value) as high from events group by 1, 2")
def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream_profile", sf_dir, uuid.uuid4())
    profile = daily_profile(stream_table(spark, sf_dir, "events"), time="ts", event_id="event_id",
                            group=["event_type"], value="value")
    stream_daily_profile(profile, f"{root}/updates", f"{root}/checkpoint").awaitTermination()
    daily = read_daily_profile(spark, f"{root}/updates", ["event_type"])
    return daily.withColumns({"window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
                              "total": F.round("total", 4)})


@query("trailing_threshold", """
    with m as (
        select event_id, 'out' as action, avg(value) over (partition by event_type order by ts
                   range between interval '5' minute preceding and current row) as mean from events
        union all
        select event_id, 'in', avg(value) over (partition by event_type order by ts
                   range between interval '10' minute preceding and current row) from events)
    select event_id, action, round(mean, 9) as mean, case when action = 'out' then mean > 70 else mean < 30 end as fires from m
""")
def trailing_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = timing.trailing_threshold(load(spark, sf_dir, "events"), row_id="event_id", series="event_type",
                                      time="ts", value="value")
    return found.withColumn("mean", F.round("mean", 9))


@query("sliding_threshold", """
    with w as (select event_type, value, unnest(range(5)) as back, date_trunc('minute', ts) as m from events)
    select event_type, strftime(m - to_minutes(back) + interval '5' minute, '%Y-%m-%d %H:%M:%S') as window_end,
           count(*) as n, round(avg(value), 6) as mean, avg(value) > 70 as fires
    from w group by 1, 2
""")
def sliding_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = timing.sliding_means(load(spark, sf_dir, "events"), series="event_type", time="ts", value="value",
                                 rule=timing.SCALING_RULES[0])
    # The rule is judged on the exact mean, before it is rounded for show.
    return means.withColumns({"window_end": F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"),
                              "mean": F.round("mean", 6)})
