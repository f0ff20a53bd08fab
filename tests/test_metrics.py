from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marram.operators import metrics, roc
from marram.operators.forest import DEFAULT_GRID, forest_settings, param_grid
from marram.operators.search import best_candidate, cv_results


@pytest.fixture(scope="module")
def judged(spark):
    """Class c is never predicted, class d never occurs."""
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "d")] * 2
    return spark.createDataFrame(pairs, "y string, p string")


def test_confusion_holds_every_pair(judged):
    counts = metrics.confusion_counts(judged, "y", "p")
    full = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(counts).collect()}
    assert len(full) == 16 and full[("a", "a")] == 3 and full[("c", "d")] == 2 and full[("d", "a")] == 0
    wide = {r.actual: r.b for r in metrics.confusion_wide(counts, "abcd").collect()}
    assert wide == {"a": 1, "b": 2, "c": 0}


def test_report_with_empty_sides(judged):
    report = metrics.classification_report(metrics.confusion_counts(judged, "y", "p"))
    got = {r.label: (r.precision, r.recall, r.f1_score, r.support) for r in report.collect()}
    assert got["a"] == (1.0, 0.75, pytest.approx(6 / 7), 4)
    assert got["b"] == (pytest.approx(2 / 3), 1.0, pytest.approx(0.8), 2)
    assert got["c"] == (0.0, 0.0, 0.0, 2) and got["d"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"][2] == 5 / 8 and got["macro avg"][0] == pytest.approx((1 + 2 / 3) / 4)
    assert got["weighted avg"][1] == pytest.approx((0.75 * 4 + 2) / 8) and got["weighted avg"][3] == 8
    shown = {r.label: tuple(r)[1:] for r in metrics.report_display(report).collect()}
    assert "accuracy" not in shown and shown["b"] == ("0.67", "1.00", "0.80", "2")


def test_alignment_is_by_key(spark):
    labels = spark.createDataFrame([(1, "x"), (2, "y")], "k int, y string")
    guesses = spark.createDataFrame([(2, "y"), (1, "z")], "k int, p string")
    assert {tuple(r) for r in metrics.align_predictions(labels, guesses, "k").collect()} == {(1, "x", "z"), (2, "y", "y")}


def brute_roc(pairs):
    points, pos, neg = [], sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    raw = []
    for t in sorted({s for _, s in pairs}, reverse=True):
        raw.append((t, sum(1 - y for y, s in pairs if s >= t), sum(y for y, s in pairs if s >= t)))
    for i, (t, fp, tp) in enumerate(raw):
        if 0 < i < len(raw) - 1:
            before, after = raw[i - 1], raw[i + 1]
            if (fp - before[1], tp - before[2]) == (after[1] - fp, after[2] - tp):
                continue
        points.append((t, fp / neg, tp / pos))
    return [(float("inf"), 0.0, 0.0), *points]


@pytest.mark.parametrize("buckets", [2, 64])
def test_roc_against_brute_force(spark, buckets):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 1), float(rng.randint(0, 25))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "positive int, score double")
    got = sorted((tuple(r) for r in roc.roc_points(df, buckets=buckets).collect()), key=lambda r: -r[0])
    want = brute_roc(pairs)
    assert len(got) == len(want)
    assert all(g == pytest.approx(w) for g, w in zip(got, want))
    wins = sum((a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z)
    area = roc.auc(df, buckets=buckets).first().auc
    assert area == pytest.approx(wins / (sum(y for y, _ in pairs) * sum(1 - y for y, _ in pairs)))


def test_auc_edge_cases(spark):
    rows = [("tied", 1, 0.5), ("tied", 0, 0.5), ("perfect", 1, 0.9), ("perfect", 0, 0.1), ("one", 1, 0.3), ("one", 1, 0.4)]
    df = spark.createDataFrame(rows, "class string, positive int, score double")
    assert {r["class"]: r.auc for r in roc.auc(df, ["class"]).collect()} == {"tied": 0.5, "perfect": 1.0, "one": None}
    points = roc.roc_points(df, ["class"]).where("class = 'one'").collect()
    assert points and all(r.fpr is None for r in points)


def test_hot_class_and_hot_score(spark):
    """A third of all rows share one score."""
    df = spark.range(3000).select((F.col("id") % 2).cast("int").alias("positive"),
                                  F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000.0).alias("score"))
    pairs = [(r.positive, r.score) for r in df.collect()]
    pos, neg = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    below, won = 0, 0.0
    for s in sorted({s for _, s in pairs}):
        p, q = sum(y for y, t in pairs if t == s), sum(1 - y for y, t in pairs if t == s)
        won, below = won + p * (below + q / 2), below + q
    assert roc.auc(df).first().auc == pytest.approx(won / (pos * neg))


def test_grid_order_and_settings():
    grid = param_grid(DEFAULT_GRID)
    assert len(grid) == 48 and len({tuple(g.items()) for g in grid}) == 48
    assert list(grid[0]) == ["model__max_depth", "model__min_samples_leaf", "model__min_samples_split", "model__n_estimators"]
    assert [g["model__n_estimators"] for g in grid[:4]] == [50, 100, 200, 50]
    assert forest_settings({"model__max_depth": None}) == {"numTrees": 100, "maxDepth": 30, "minInstancesPerNode": 1}
    assert forest_settings({"min_samples_split": 5, "min_samples_leaf": 1})["minInstancesPerNode"] == 3


def test_cv_table_ties(spark):
    scores = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.7), (1, 0, 0.7), (1, 1, 0.5), (2, 0, 0.1), (2, 1, 0.1)],
                                   "candidate_id int, fold int, score double")
    table = cv_results(scores, 2)
    got = {r.candidate_id: (r.split0_test_score, r.rank_test_score) for r in table.collect()}
    assert got == {0: (0.5, 1), 1: (0.7, 1), 2: (0.1, 3)}
    assert table.where("candidate_id = 0").first().std_test_score == pytest.approx(0.1)
    assert best_candidate(table).first().candidate_id == 0
