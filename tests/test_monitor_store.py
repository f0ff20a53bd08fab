"""The incremental monitor: late batches, replaced batches, and what a day's report reads."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from marram.plans.monitor_store import MonitorStore, monitor_day

ROWS = "x double, y double, collected_at timestamp_ntz"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "x double, y double, at string").select(
        "x", "y", F.col("at").cast("timestamp_ntz").alias("collected_at"))


@pytest.fixture
def store(spark, tmp_path):
    held = MonitorStore(str(tmp_path), {"x": [1.0, 2.0], "y": [10.0]}, {"x": (0.0, 3.0), "y": (0.0, 20.0)})
    held.set_baseline(_rows(spark, *[(k % 3 + 0.5, 5.0 + 10 * (k % 2), "2024-01-01 00:00:00") for k in range(12)]))
    return held


def _report(store, spark, **days):
    return {(str(r.monitor_day), r.feature): r for r in store.report(spark, **days).collect()}


def test_days_end_at_a_quarter_past_three(spark):
    rows = _rows(spark, (0.0, 0.0, "2024-01-02 03:14:59"), (0.0, 0.0, "2024-01-02 03:15:00"), (0.0, 0.0, "2024-01-02 23:00:00"))
    days = rows.select(monitor_day(F.col("collected_at")).alias("d")).collect()
    assert [str(r.d) for r in days] == ["2024-01-02", "2024-01-03", "2024-01-03"]


def test_a_late_batch_changes_its_day_only(spark, store):
    store.add(_rows(spark, (0.5, 5.0, "2024-01-02 12:00:00"), (1.5, None, "2024-01-03 12:00:00")), 1)
    before = _report(store, spark)
    store.add(_rows(spark, (9.0, float("nan"), "2024-01-02 13:00:00")), 2)
    after = _report(store, spark)
    assert {k for k in after if after[k] != before[k]} == {("2024-01-03", "x"), ("2024-01-03", "y")}
    x = after["2024-01-03", "x"]
    assert (x.n_rows, x.n_missing, x.n_outside, x.mean, x.low, x.high) == (2, 0, 1, 4.75, 0.5, 9.0)
    y = after["2024-01-03", "y"]
    assert (y.n_rows, y.n_missing, y.mean) == (2, 1, 5.0)


def test_a_batch_added_again_replaces_itself(spark, store):
    store.add(_rows(spark, (0.5, 5.0, "2024-01-02 12:00:00"), (0.5, 5.0, "2024-01-05 12:00:00")), 1)
    store.add(_rows(spark, (1.5, 5.0, "2024-01-02 12:00:00")), 2)
    store.add(_rows(spark, (2.5, 5.0, "2024-01-02 12:00:00")), 1)
    report = _report(store, spark)
    assert {d for d, _ in report} == {"2024-01-03"} and report["2024-01-03", "x"].mean == 2.0


def test_a_report_opens_its_days_only(spark, store):
    store.add(_rows(spark, *[(0.5, 5.0, f"2024-01-{d:02d} 12:00:00") for d in range(2, 9)]), 1)
    plan = store.read(spark, date(2024, 1, 4), date(2024, 1, 4))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(monitor_day" in plan
    assert {d for d, _ in _report(store, spark, first=date(2024, 1, 4), last=date(2024, 1, 5))} == {"2024-01-04", "2024-01-05"}


def test_equal_shares_have_no_distance(spark, store):
    store.add(_rows(spark, *[(k % 3 + 0.5, 5.0 + 10 * (k % 2), "2024-01-02 12:00:00") for k in range(12)]), 1)
    assert all(r.psi == pytest.approx(0) and r.js_distance == pytest.approx(0) for r in _report(store, spark).values())
