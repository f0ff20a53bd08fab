from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marram.operators.catalogs import (
    first_by_key, latest_by, latest_version, next_version, require_latest, traffic_shares,
)
from marram.operators.entities import asof_lookup, build_feature_source, latest_features, with_entity_ids
from marram.schema import FLOWERS


def test_feature_source(spark, flowers):
    source = build_feature_source(flowers.repartition(3), FLOWERS, "row_key")
    assert source.columns == ["flower_id", "event_timestamp", *FLOWERS.model_features, "species"]
    rows = source.orderBy("flower_id").collect()
    assert [r.flower_id for r in rows[:2]] == ["flower_00001", "flower_00002"] and len(rows) == 150
    assert [r.event_timestamp for r in rows[:2]] == ["2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z"]
    assert rows[24].event_timestamp == "2024-01-02T00:00:00Z"
    assert all(r["petal length squared"] == r["petal length (cm)"] * r["petal length (cm)"] for r in rows)
    with pytest.raises(ValueError, match="species"):
        build_feature_source(flowers.drop("species"), FLOWERS, "row_key")


def test_ids_do_not_depend_on_layout_or_buckets(flowers):
    seen = {
        tuple(sorted((r.row_key, r.flower_id) for r in with_entity_ids(df, "row_key", buckets=b).collect()))
        for df in (flowers.coalesce(1), flowers.repartition(7)) for b in (2, 50)
    }
    assert len(seen) == 1


def test_id_text_widens(spark):
    df = spark.range(100_001).withColumnRenamed("id", "n")
    last = with_entity_ids(df, "n").where("n = 100000").first()
    assert last.flower_id == "flower_100001"


@pytest.fixture(scope="module")
def history(spark):
    """One key holds most rows; equal times occur."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    at = lambda: start + timedelta(minutes=rng.randint(0, 600))
    key = lambda: "hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}"
    facts = [(i, key(), at(), float(i)) for i in range(300)]
    asks = [(i, key(), at()) for i in range(200)] + [(900, "never", at()), (901, None, at())]
    return facts, asks


def brute_asof(facts, asks, max_age=None):
    out = {}
    for i, k, t in asks:
        seen = [(ft, str(j), v) for j, fk, ft, v in facts if fk == k and ft <= t]
        ft, _, v = max(seen) if seen else (None, None, None)
        if ft is not None and max_age is not None and ft < t - max_age:
            ft, v = None, None
        out[i] = (ft, v)
    return out


@pytest.mark.parametrize("hot_limit", [None, 50])
@pytest.mark.parametrize("max_age", [None, timedelta(minutes=3)])
def test_asof_against_brute_force(spark, history, hot_limit, max_age):
    facts, asks = history
    right = spark.createDataFrame(facts, "fid int, key string, at timestamp_ntz, x double")
    left = spark.createDataFrame(asks, "ask int, key string, at timestamp_ntz")
    got = asof_lookup(left, right, key="key", spine_time="at", feature_time="at", columns=["x"], tie="fid",
                      max_age=max_age, hot_limit_rows=hot_limit, time_buckets=6)
    assert got.columns == ["ask", "key", "at", "feature_ts", "feature_x"]
    assert {r.ask: (r.feature_ts, r.feature_x) for r in got.collect()} == brute_asof(facts, asks, max_age)


def test_latest_features(spark, history):
    facts, _ = history
    df = spark.createDataFrame(facts, "fid int, key string, at timestamp_ntz, x double")
    got = {r.key: (r["at"], r.x) for r in latest_features(df, "key", "at", ["x"]).collect()}
    want = {}
    for _, k, t, v in facts:
        want[k] = max(want.get(k, (t, v)), (t, v))
    assert got == want


def test_versions(spark):
    df = spark.createDataFrame([("a", v) for v in ("1", "2", "10", "beta", None)] + [("b", "alpha")], "asset string, v string")
    assert {tuple(r) for r in next_version(df, "asset", "v").collect()} == {("a", "11"), ("b", "1")}
    assert {tuple(r) for r in latest_version(df.where("v is not null"), "asset", "v").collect()} == {("a", "beta"), ("b", "alpha")}
    assert {tuple(r) for r in latest_version(df, "asset", "v", "numeric_only").collect()} == {("a", "10"), ("b", None)}


def test_latest_and_first(spark):
    runs = spark.createDataFrame([("r1", 5, 1), ("r2", 9, 2), ("r3", 9, 1)], "run string, started int, tie int")
    assert latest_by(runs, "started", "tie", ["run"]).first().run == "r2"
    assert require_latest(runs, "started", "tie", ["run"]) == {"run": "r2"}
    with pytest.raises(LookupError, match="no run found"):
        require_latest(runs.where("started > 100"), "started", "tie", ["run"])
    assert first_by_key(runs, "started").first().run == "r1"


def test_traffic(spark):
    df = spark.createDataFrame([("e1", "blue", 90), ("e1", "green", 10), ("e2", "blue", 100), ("e3", "green", 100)],
                               "endpoint string, deployment string, n int")
    got = {tuple(r) for r in traffic_shares(df, "endpoint", "deployment", "n", "blue").collect()}
    assert got == {("e1", 90, True, "green", 10, 1.0), ("e2", 100, True, "blue", 0, 0.0), ("e3", 0, False, "green", 100, 1.0)}


def test_keys_of_any_orderable_type(spark):
    """Texts with prefixes of each other, nulls, negative numbers and times are numbered as Spark sorts them."""
    texts = ["", "a", "ab", "a!", "a b", "é", "z", "flower_1", "flower_10", "flower_2", None]
    rows = [(t, n, f"2024-01-0{1 + n % 3} 00:00:0{n % 7}.{n % 2}") for t in texts for n in (-5, -1, 0, 7, 1 << 40)]
    df = spark.createDataFrame(rows, "t string, n long, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    for keys in (["t", "n"], ["at", "t", "n"], ["n", "t"]):
        got = with_entity_ids(df.repartition(5), keys, key_format="%d", buckets=7).collect()
        wanted = {(r.t, r.n): k for k, r in enumerate(df.orderBy(*keys).collect(), 1)}
        assert {(r.t, r.n): int(r.flower_id) for r in got} == wanted
    with pytest.raises(TypeError, match="no order"):
        with_entity_ids(df.withColumn("d", F.lit(1.5)), ["t", "d"])
