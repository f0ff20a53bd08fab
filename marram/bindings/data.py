"""Scans, projections, labels, keys, splits, lookups and catalogs on the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.bindings.registry import (
    EVENT_SQL, EVENTS, LINES, STATUS_CODES, event_measurements, load, query,
)
from marram.functions.features import decode_label, encode_label, unknown_labels
from marram.functions.text import STORE_PREFIX, abfss_uri, parse_store_uri, text_to_bool
from marram.operators import catalogs, entities, splits
from marram.schema import ISO_SECONDS, FeatureSetSpec
from marram.session import scratch_path
from marram.sources import readers, sinks


@query("scan_canonical", """
    select l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax,
           l_returnflag as return_flag
    from lineitem
""")
def scan_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scan_canonical", sf_dir)
    lines = load(spark, sf_dir, "lineitem").select("l_linestatus", *LINES.rename)
    lines.write.mode("overwrite").option("header", True).csv(path)
    return readers.read_canonical_csv(spark, path, LINES)


@query("source_fallback", """
    select o_orderkey, o_orderstatus, 'order table' as source_description from orders
""")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = [
        readers.Candidate("explicit path", f"{sf_dir}/no_such_orders.parquet"),
        readers.Candidate("order table", f"{sf_dir}/orders.parquet"),
        readers.Candidate("line table", f"{sf_dir}/lineitem.parquet"),
    ]
    found = readers.resolve_source(spark, chain, strict=False)
    return found.select("o_orderkey", "o_orderstatus", "source_description")


EVENT_SPEC = FeatureSetSpec("event_features", ("event_key",), {"value": "double", "k": "int"})


@query("feature_set_read", """
    with raw as (
        select *, case when event_id % 11 = 0 then 'index:event_key' when event_id % 13 = 0 then 'timestamp'
                       when event_id % 17 = 0 then 'type:value' end as reason
        from events)
    select case when event_id % 11 = 0 then null else 'ev_' || event_id end as event_key,
           case when event_id % 13 = 0 then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end as event_time,
           case when event_id % 17 = 0 then null else value end as value,
           cast(json_extract_string(props, '$.k') as integer) as k, reason as reject_reason
    from raw
""")
def feature_set_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("event_id"), F.date_format("ts", ISO_SECONDS)
    raw = load(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").alias("k"),
        F.when(key % 17 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(key % 13 == 0, "yesterday").otherwise(text).alias("event_timestamp"),
        F.when(key % 11 != 0, F.concat(F.lit("ev_"), key.cast("string"))).alias("event_key"),
    )
    path = scratch_path(spark, "feature_set_read", sf_dir)
    raw.write.mode("overwrite").option("header", True).csv(path)
    kept, refused = readers.read_feature_set(spark, EVENT_SPEC, path)
    both = kept.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(refused)
    return both.select("event_key", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
                       "value", "k", "reject_reason")


@query("asset_uri_parse", """
    with u as (
        select doc_id, case when doc_id % 5 = 0 then 'https://host/' || source || '/paths/' || doc_id
                            when doc_id % 7 = 0 then 'azureml://datastores/' || source || '/files/' || doc_id
                            else 'azureml://datastores/' || source || '/paths/' || lang || '/paths/' || doc_id end as uri
        from documents),
    p as (select doc_id, uri, case when uri like 'azureml://datastores/%' and contains(uri, '/paths/')
                                   then substr(uri, 22) end as rest from u)
    select doc_id, split_part(rest, '/paths/', 1) as store,
           substr(rest, strpos(rest, '/paths/') + 7) as path,
           'abfss://lake@acct.dfs.core.windows.net/' || substr(rest, strpos(rest, '/paths/') + 7) as address
    from p
""")
def asset_uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    store = F.lit(STORE_PREFIX)
    uri = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("https://host/"), "source", F.lit("/paths/"), doc))
        .when(F.col("doc_id") % 7 == 0, F.concat(store, "source", F.lit("/files/"), doc))
        .otherwise(F.concat(store, "source", F.lit("/paths/"), "lang", F.lit("/paths/"), doc))
    )
    parsed = load(spark, sf_dir, "documents").select("doc_id", parse_store_uri(uri).alias("p"))
    leading = F.concat(F.lit("//"), F.col("p.path"))
    return parsed.select("doc_id", "p.store", "p.path",
                         abfss_uri(F.lit("acct"), F.lit("lake"), leading).alias("address"))


def event_feature_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.build_feature_source(
        event_measurements(load(spark, sf_dir, "events")), EVENTS, "event_id")


FEATURE_SOURCE_SQL = f"""
    with e as ({EVENT_SQL}),
    n as (select *, row_number() over (order by event_id) as rn from e)
    select 'flower_' || case when rn < 100000 then lpad(cast(rn as varchar), 5, '0') else cast(rn as varchar) end as flower_id,
           strftime(timestamp '2024-01-01 00:00:00' + to_hours(cast(rn - 1 as bigint)), '%Y-%m-%dT%H:%M:%SZ') as event_timestamp,
           value, k, "user", hour, value * value as value_squared, k * k as k_squared, value * k as value_k,
           "user" * hour as user_hour, value * "user" as value_user, event_type
    from n
"""


@query("feature_source", FEATURE_SOURCE_SQL)
def feature_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_feature_source(spark, sf_dir)


@query("feature_source_roundtrip", f"""
    select * replace (replace(replace(event_timestamp, 'T', ' '), 'Z', '') as event_timestamp)
    from ({FEATURE_SOURCE_SQL})
""")
def feature_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = event_feature_source(spark, sf_dir)
    path = scratch_path(spark, "feature_source", sf_dir)
    sinks.write_feature_source(built, path, format="csv")
    spec = FeatureSetSpec.of(built, "event_measurements", ("flower_id",))
    kept, _ = readers.read_feature_set(spark, spec, path)
    return kept.withColumn("event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("feature_registry", f"""
    with s as ({FEATURE_SOURCE_SQL}),
    a as (select count(*) as n_rows, min(event_timestamp) as first_event, max(event_timestamp) as last_event,
                 [count(value), count(k), count("user"), count(hour), count(value_squared), count(k_squared),
                  count(value_k), count(user_hour), count(value_user), count(event_type)] as counts from s),
    f as (select unnest(range(1, 11)) as position)
    select 'event_measurements' as feature_set, '1' as version, 'flower' as entity, '1' as entity_version,
           'flower_id' as index_columns, 'event_timestamp' as timestamp_column,
           'yyyy-MM-dd''T''HH:mm:ss''Z''' as timestamp_format, n_rows, first_event, last_event,
           cast(position as integer) as position,
           ['value', 'k', 'user', 'hour', 'value_squared', 'k_squared', 'value_k', 'user_hour', 'value_user',
            'event_type'][position] as feature,
           case when position = 10 then 'string' else 'double' end as type, counts[position] as n_values
    from a, f
""")
def feature_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = event_feature_source(spark, sf_dir)
    return sinks.registry_records(built, FeatureSetSpec.of(built, "event_measurements", ("flower_id",)))


@query("input_example", f"""
    select event_id, value, k, "user", hour from ({EVENT_SQL}) order by event_id limit 1
""")
def input_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_measurements(load(spark, sf_dir, "events"))
    return catalogs.first_by_key(rows.select("event_id", *EVENTS.features), "event_id")


LINE_PRODUCTS_SQL = """
    l_quantity * l_quantity as quantity_squared, l_extendedprice * l_extendedprice as price_squared,
    l_quantity * l_extendedprice as quantity_price, l_discount * l_tax as discount_tax,
    l_quantity * l_discount as quantity_discount
"""


@query("derived_features", f"select l_returnflag as return_flag, {LINE_PRODUCTS_SQL} from lineitem")
def derived_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = LINES.canonical(load(spark, sf_dir, "lineitem"))
    return LINES.with_products(lines).select("return_flag", *LINES.products)


@query("derived_refresh", f"select l_shipdate is null as unshipped, l_linestatus, {LINE_PRODUCTS_SQL} from lineitem")
def derived_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = load(spark, sf_dir, "lineitem").withColumnsRenamed(dict(LINES.rename))
    stale = renamed.withColumns({name: F.lit(-1.0) for name in LINES.products})
    fresh = LINES.with_products(stale)
    return fresh.select(F.col("l_shipdate").isNull().alias("unshipped"), "l_linestatus", *LINES.products)


@query("model_feature_frame", f"""
    select l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax,
           {LINE_PRODUCTS_SQL} from lineitem
""")
def model_feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LINES.model_frame(LINES.canonical(load(spark, sf_dir, "lineitem")))


@query("label_encode", """
    select o_orderkey, case o_orderstatus when 'F' then 0 when 'O' then 1 when 'P' then 2 end as label_code from orders
""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", encode_label(F.col("o_orderstatus"), STATUS_CODES).alias("label_code"))


@query("unknown_labels", """
    select distinct coalesce(nullif(event_type, 'view'), 'null') as unknown_label from events
    where coalesce(nullif(event_type, 'view'), 'null') not in ('click', 'error')
""")
def unknown_label_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("view")).alias("event_type"))
    return unknown_labels(events, "event_type", {"click": 0, "error": 1})


@query("label_decode", """
    select o_orderkey, case o_orderkey % 5 when 0 then 'F' when 1 then 'O' when 2 then 'P'
                       else cast(cast(o_orderkey % 5 as double) as varchar) end as predicted_label from orders
""")
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    prediction = (F.col("o_orderkey") % 5).cast("double")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", decode_label(prediction, STATUS_CODES).alias("predicted_label"))


@query("scalar_text_bool", """
    with t as (select event_id, ['Yes', ' TRUE ', '1', 'y', 'False', '0', 'NO', ' n', 'maybe', ''][1 + event_id % 10] as word
               from events)
    select event_id, case when lower(trim(word)) in ('true', '1', 'yes', 'y') then 'true'
                          when lower(trim(word)) in ('false', '0', 'no', 'n') then 'false' else 'neither' end as switch
    from t
""")
def scalar_text_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in ("Yes", " TRUE ", "1", "y", "False", "0", "NO", " n", "maybe", "")])
    word = F.element_at(words, (F.col("event_id") % 10 + 1).cast("int"))
    switch = F.coalesce(text_to_bool(word).cast("string"), F.lit("neither"))
    return load(spark, sf_dir, "events").select("event_id", switch.alias("switch"))


@query("entity_ids", """
    with n as (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders)
    select o_orderkey,
           'flower_' || case when rn < 100000 then lpad(cast(rn as varchar), 5, '0') else cast(rn as varchar) end as flower_id,
           strftime(timestamp '2024-01-01 00:00:00' + to_hours(cast(rn - 1 as bigint)), '%Y-%m-%dT%H:%M:%SZ') as event_timestamp
    from n
""")
def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.with_entity_ids(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query("entity_ids_text", """
    select c_name, 'flower_' || lpad(cast(row_number() over (order by c_name) as varchar), 5, '0') as flower_id from customer
""")
def entity_ids_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = entities.with_entity_ids(load(spark, sf_dir, "customer").select("c_name"), "c_name")
    return numbered.select("c_name", "flower_id")


@query("entity_ids_composite", """
    select o_orderkey, row_number() over (order by o_orderpriority, o_orderdate, o_orderkey) as number from orders
""")
def entity_ids_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered by a text, a time and a number together; the first alone has five values."""
    keys = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    numbered = entities.with_entity_ids(load(spark, sf_dir, "orders").select(*keys), keys, key_format="%d")
    return numbered.select("o_orderkey", F.col("flower_id").cast("long").alias("number"))


SPLIT_SQL = """
    with c as (select o_orderstatus as label, count(*) as n from orders group by 1),
    t as (select *, sum(n) over () as total, cast(ceil(0.2e0 * sum(n) over ()) as bigint) as n_test from c),
    q as (select label, n_test, cast(n_test * n // total as bigint) as base, n_test * n % total as rest from t),
    w as (select label, base + case when row_number() over (order by rest desc, label) <= n_test - sum(base) over ()
                                    then 1 else 0 end as quota from q),
    r as (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus
            order by md5('5901:' || o_orderkey), o_orderkey) as rk from orders)
    select o_orderkey, o_orderstatus, case when rk <= quota then 'test' else 'train' end as split
    from r join w on r.o_orderstatus = w.label
"""


def order_split(orders: DataFrame) -> DataFrame:
    return splits.stratified_split(orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


@query("stratified_split", SPLIT_SQL)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_split(load(spark, sf_dir, "orders"))


@query("split_stability", f"""
    select o_orderstatus, split, count(*) as n, cast(0 as bigint) as n_changed from ({SPLIT_SQL}) group by 1, 2
""")
def split_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split rebuilt from rows laid out another way: no row may change sides."""
    orders = load(spark, sf_dir, "orders")
    moved = orders.repartition(7, F.col("o_custkey"))
    again = order_split(moved).select("o_orderkey", F.col("split").alias("split_again"))
    both = order_split(orders).join(again, "o_orderkey")
    return both.groupBy("o_orderstatus", "split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") != F.col("split_again")).alias("n_changed"))


@query("split_disjoint", f"""
    with s as ({SPLIT_SQL})
    select (select count(*) from s where split = 'train') as n_train,
           (select count(*) from s where split = 'test') as n_test,
           (select count(*) from s a join s b on a.o_orderkey = b.o_orderkey
             where a.split = 'train' and b.split = 'test') as n_both,
           (select count(*) from orders) - (select count(*) from s) as n_lost
""")
def split_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    whole = order_split(orders)
    overlap = splits.split_overlap(whole.where("split = 'train'"), whole.where("split = 'test'"), "o_orderkey")
    sides = whole.select("o_orderkey", F.col("split").alias("side"))
    marked = sides.unionByName(overlap.select("o_orderkey", F.lit("both").alias("side"))).unionByName(
        orders.select("o_orderkey", F.lit("all").alias("side")))
    n = lambda side: F.count_if(F.col("side") == side)
    return marked.agg(n("train").alias("n_train"), n("test").alias("n_test"), n("both").alias("n_both"),
                      (n("all") - n("train") - n("test")).alias("n_lost"))


FOLD_SQL = """
    with c as (select o_orderstatus as label, count(*) as n from orders group by 1),
    s as (select label, n, coalesce(sum(n) over (order by label rows between unbounded preceding and 1 preceding), 0) as s from c),
    d as (select label, f, (select count(*) from range(cast(s as bigint), cast(s + n as bigint)) g(i) where i % 5 = f) as size
          from s, unnest([0, 1, 2, 3, 4]) u(f)),
    e as (select label, f, sum(size) over (partition by label order by f) as upto from d),
    r as (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus
            order by md5('5901:' || o_orderkey), o_orderkey) as rk from orders)
    select o_orderkey, o_orderstatus, cast((select count(*) from e where e.label = r.o_orderstatus and e.upto < r.rk) as integer) as fold
    from r
"""


def order_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_kfold(orders, "o_orderkey", "o_orderstatus", folds=5)


@query("stratified_kfold", FOLD_SQL)
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_folds(spark, sf_dir)


@query("learning_curve_samples", f"""
    with k as ({FOLD_SQL}),
    z as (select count(*) as first_rows from k where fold <> 0),
    m as (select k.o_orderkey, v.f as valid_fold, row_number() over (partition by v.f
            order by md5('5901:' || k.o_orderkey), k.o_orderkey) as rk
          from k, unnest([0, 1, 2, 3, 4]) v(f) where k.fold <> v.f)
    select o_orderkey, valid_fold,
           case when rk <= cast(floor(0.2e0 * first_rows) as bigint) then 1 when rk <= cast(floor(0.4e0 * first_rows) as bigint) then 2
                when rk <= cast(floor(0.6e0 * first_rows) as bigint) then 3 when rk <= cast(floor(0.8e0 * first_rows) as bigint) then 4
                when rk <= first_rows then 5 else 0 end as first_step
    from m, z
""")
def learning_curve_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = splits.prefix_samples(order_folds(spark, sf_dir), "o_orderkey", "fold", folds=5)
    return sampled.select("o_orderkey", "valid_fold", F.coalesce("first_step", F.lit(0)).alias("first_step"))


@query("asof_features", """
    select p.event_id, p.user_id, strftime(v.ts, '%Y-%m-%d %H:%M:%S.%f') as feature_ts, v.value as feature_value
    from (select * from events where event_type = 'purchase') p
    asof left join (select * from events where event_type = 'view') v
      on p.user_id = v.user_id and p.ts >= v.ts
""")
def asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    found = entities.asof_lookup(
        events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"),
        events.where("event_type = 'view'").select("event_id", "user_id", "ts", "value"),
        key="user_id", spine_time="ts", feature_time="ts", columns=["value"], tie="event_id",
    )
    return found.select("event_id", "user_id",
                        F.date_format("feature_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("feature_ts"), "feature_value")


@query("latest_features", """
    select user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as ts, arg_max(event_type, ts) as event_type,
           arg_max(value, ts) as value
    from events group by user_id
""")
def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = entities.latest_features(load(spark, sf_dir, "events"), "user_id", "ts", ["event_type", "value"])
    return newest.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


VERSIONS_SQL = """
    select o_orderpriority as asset, o_orderdate as created, o_orderkey,
           case when o_orderkey % 7 = 0 and o_orderpriority < '4' then 'beta' || (o_orderkey % 50)
                else cast(o_orderkey as varchar) end as version
    from orders
"""


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = (key % 7 == 0) & (F.col("o_orderpriority") < "4")
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("asset"), F.col("o_orderdate").alias("created"), "o_orderkey",
        F.when(text, F.concat(F.lit("beta"), (key % 50).cast("string"))).otherwise(key.cast("string")).alias("version"),
    )


@query("next_version", f"""
    select asset, cast(coalesce(max(try_cast(version as bigint)), 0) + 1 as varchar) as next_version
    from ({VERSIONS_SQL}) group by asset
""")
def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.next_version(order_versions(spark, sf_dir), "asset", "version")


@query("latest_version", f"""
    with v as ({VERSIONS_SQL}),
    r as (select asset, version, row_number() over (partition by asset order by
            case when try_cast(version as bigint) is null then 1 else 0 end desc,
            try_cast(version as bigint) desc, version desc) as rn from v)
    select a.asset, a.version as text_last_wins, cast(b.top as varchar) as numeric_only
    from r a join (select asset, max(try_cast(version as bigint)) as top from v group by asset) b on a.asset = b.asset
    where a.rn = 1
""")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = order_versions(spark, sf_dir)
    newest = catalogs.latest_version(versions, "asset", "version").withColumnRenamed("latest_version", "text_last_wins")
    numbers = catalogs.latest_version(versions, "asset", "version", "numeric_only")
    return newest.join(numbers.withColumnRenamed("latest_version", "numeric_only"), "asset")


@query("latest_run", """
    select o_orderkey as run_id, strftime(o_orderdate, '%Y-%m-%d') as start_date from orders
    order by o_orderdate desc, o_orderkey desc limit 1
""")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = catalogs.latest_by(load(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", ["o_orderkey", "o_orderdate"])
    return newest.select(F.col("o_orderkey").alias("run_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"))


@query("latest_job", """
    select event_id as job_id, user_id as owner from events where event_type = 'purchase'
    order by ts desc, event_id desc limit 1
""")
def latest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = load(spark, sf_dir, "events").where("event_type = 'purchase'")
    newest = catalogs.latest_by(jobs, "ts", "event_id", ["event_id", "user_id"])
    return newest.select(F.col("event_id").alias("job_id"), F.col("user_id").alias("owner"))


@query("traffic_shares", """
    with t as (select o_orderpriority as endpoint,
                      case when o_orderpriority = '1-URGENT' then 'F' else o_orderstatus end as deployment, count(*) as t
               from orders group by 1, 2),
    g as (select endpoint, coalesce(sum(case when deployment = 'F' then t end), 0) as target_traffic,
                 sum(case when deployment <> 'F' then t end) as rest from t group by 1)
    select g.endpoint, cast(target_traffic as bigint) as target_traffic, target_traffic > 0 as has_traffic,
           coalesce(t.deployment, 'F') as deployment, cast(coalesce(t.t, 0) as bigint) as traffic_left,
           round(coalesce(t.t / rest, 0), 9) as share_left
    from g left join t on t.endpoint = g.endpoint and t.deployment <> 'F'
""")
def traffic_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One endpoint sends everything to the deployment that is taken away.
    target = F.when(F.col("o_orderpriority") == "1-URGENT", "F").otherwise(F.col("o_orderstatus"))
    traffic = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("endpoint"), target.alias("deployment"), F.lit(1).alias("requests"))
    left = catalogs.traffic_shares(traffic, "endpoint", "deployment", "requests", "F")
    return left.withColumn("share_left", F.round("share_left", 9))
