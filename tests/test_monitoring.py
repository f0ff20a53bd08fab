from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marram.operators import drift, profiles, timing
from marram.streaming.profile import daily_profile, read_daily_profile, stream_daily_profile


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(11)
    rows = [(float(rng.randint(0, 40)), False) for _ in range(150)] + [(float(rng.randint(10, 60)), True) for _ in range(120)]
    return rows, spark.createDataFrame(rows, "x double, cur boolean")


@pytest.mark.parametrize("buckets", [2, 64])
def test_exact_drift_against_brute_force(samples, buckets):
    rows, df = samples
    old, new = [x for x, c in rows if not c], [x for x, c in rows if c]
    share = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    points = sorted({x for x, _ in rows})
    gaps = [abs(share(old, v) - share(new, v)) for v in points]
    w1 = sum(g * (b - a) for g, a, b in zip(gaps, points, points[1:]))
    got = drift.exact_drift(df, "x", F.col("cur"), buckets=buckets).first()
    assert got.ks == pytest.approx(max(gaps)) and got.wasserstein_1 == pytest.approx(w1)


def test_identical_samples_do_not_drift(spark):
    df = spark.range(100).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") >= 50).alias("cur"))
    assert tuple(drift.exact_drift(df, "x", F.col("cur")).first()) == ("x", 0.0, 0.0)
    row = drift.binned_drift(df, F.col("cur"), {"x": [3.0, 6.0]}).first()
    assert row.psi == pytest.approx(0) and row.js_distance == pytest.approx(0)


def test_unseen_bins_take_part(spark):
    """Bins without any row still get their half."""
    df = spark.createDataFrame([(1.0, False), (1.0, False), (9.0, True)], "x double, cur boolean")
    pb, pc = [2.5 / 4, 0.5 / 4, 0.5 / 4, 0.5 / 4], [0.5 / 3, 0.5 / 3, 0.5 / 3, 1.5 / 3]
    got = drift.binned_drift(df, F.col("cur"), {"x": [2.0, 4.0, 6.0]}).first()
    assert got.psi == pytest.approx(sum((c - b) * math.log(c / b) for b, c in zip(pb, pc)))
    m = [(b + c) / 2 for b, c in zip(pb, pc)]
    js = sum(b * math.log(b / x) + c * math.log(c / x) for b, c, x in zip(pb, pc, m)) / 2
    assert got.js_distance == pytest.approx(math.sqrt(js))


def test_label_drift(spark):
    df = spark.createDataFrame([("a", False), ("b", False), ("a", True), ("c", True)], "y string, cur boolean")
    row = drift.categorical_drift(df, "y", F.col("cur")).first()
    assert row.labels == 3 and row.total_variation == pytest.approx(0.5)
    assert row.js_distance == pytest.approx(math.sqrt(0.5 * math.log(2)))


def test_quality_counts(spark):
    df = spark.createDataFrame([("1", "5"), (None, "x"), ("99", None), ("-1", "7")], "a string, b string")
    got = {r.feature: r for r in profiles.data_quality(df, ["a", "b"], {"a": (0.0, 50.0), "b": (0.0, 6.0)}).collect()}
    assert (got["a"].nulls, got["a"].type_errors, got["a"].out_of_bounds) == (1, 0, 2)
    assert (got["b"].nulls, got["b"].type_errors, got["b"].out_of_bounds) == (1, 1, 1)
    assert got["a"].out_of_bounds_rate == 0.5


def test_profile_and_quantiles(spark):
    values = [float(x) for x in [1] * 40 + list(range(2, 62))]
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v, -v if v < 50 else None) for v in values], "a double, b double")
    assert profiles.value_bounds(df, ["a"]) == {"a": (1.0, 61.0)}
    got = {r.feature: r for r in profiles.feature_profile(df, ["a", "b"]).collect()}
    for name, column in (("a", values), ("b", [-v for v in values if v < 50])):
        ordered = sorted(column)
        for p in (0.25, 0.5, 0.75):
            assert got[name][f"q{round(p * 100)}"] == ordered[math.ceil(p * len(ordered)) - 1]
        assert got[name].n == len(column) and got[name].mean == pytest.approx(sum(column) / len(column))
    rough = {r.feature: r for r in profiles.feature_profile(df, ["a"], exact=False).collect()}
    assert rough["a"].q50 == sorted(values)[49]


def test_trailing_means_against_brute_force(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [(i, rng.choice("ab"), start + timedelta(seconds=30 * rng.randint(0, 150)), rng.uniform(0, 100)) for i in range(250)]
    df = spark.createDataFrame(rows, "id int, s string, t timestamp_ntz, v double")
    got = {(r.id, r.action): (r["mean"], r.fires) for r in
           timing.trailing_threshold(df, row_id="id", series="s", time="t", value="v").collect()}
    assert len(got) == 500
    for i, s, t, _ in rows:
        for action, minutes in (("out", 5), ("in", 10)):
            inside = [v for _, s2, t2, v in rows if s2 == s and t - timedelta(minutes=minutes) <= t2 <= t]
            mean = sum(inside) / len(inside)
            assert got[(i, action)] == (pytest.approx(mean), mean > 70 if action == "out" else mean < 30)


def test_day_starts_at_quarter_past_three(spark):
    times = [datetime(2024, 1, 2, 3, 14, 59), datetime(2024, 1, 2, 3, 15), datetime(2024, 1, 3, 3, 14)]
    df = spark.createDataFrame([(t, 1) for t in times], "t timestamp_ntz, v int")
    got = {r.window_start: r.n for r in timing.daily_counts(df, "t", []).collect()}
    assert got == {datetime(2024, 1, 1, 3, 15): 1, datetime(2024, 1, 2, 3, 15): 2}


def test_streaming_profile_drops_repeats_and_late_rows(spark, tmp_path):
    schema = "event_id int, ts timestamp, kind string, value double"
    day = lambda d, h: datetime(2024, 1, d, h)
    batches = [
        [(1, day(1, 10), "a", 1.0), (2, day(1, 11), "a", 2.0), (2, day(1, 11), "a", 2.0)],
        [(2, day(1, 11), "a", 2.0), (3, day(2, 10), "b", 5.0), (4, day(9, 10), "a", 7.0)],
        [(5, day(1, 12), "a", 100.0), (6, day(9, 11), "a", 9.0)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        profile = daily_profile(source, time="ts", event_id="event_id", group=["kind"], value="value")
        stream_daily_profile(profile, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = {(r.window_start.day, r.kind): (r.n, r.total) for r in read_daily_profile(spark, str(tmp_path / "out"), ["kind"]).collect()}
    assert got == {(1, "a"): (2, 3.0), (2, "b"): (1, 5.0), (9, "a"): (2, 16.0)}


def test_trailing_windows_are_dealt_to_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    rows = spark.range(2000).selectExpr("id", "'a' as s", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, id) as t", "1.0 as v")
    monkeypatch.setattr(timing, "ROWS_PER_TASK", 250)
    found = timing.trailing_threshold(rows, row_id="id", series="s", time="t", value="v")
    assert "hashpartitioning" in (plan := found._jdf.queryExecution().toString()) and ", 48)" in plan
    assert found.where("mean = 1").count() == 4000
