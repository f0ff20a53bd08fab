"""Trees grown inside tasks against plain Python."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from marram.operators import curves, growth
from marram.operators.forest import accuracies, grow_forest, training_table
from marram.operators.search import grid_search
from marram.operators.trees import Rule


def _coded(x, label, classes=3, **more):
    values, codes = [], np.empty(x.shape, dtype=np.uint16)
    for f in range(x.shape[1]):
        distinct, codes[:, f] = np.unique(x[:, f], return_inverse=True)
        values.append(distinct)
    return growth.CodedRows(codes, values, np.asarray(label), classes, more)


def _counts(rows, classes=3):
    return [sum(w for _, y, w in rows if y == c) for c in range(classes)]


def _score(*sides):
    return sum(sum(n * n for n in _counts(s)) / sum(_counts(s)) for s in sides)


def _best(rows, f, leaf, thresholds):
    """(score, threshold) of the best cut of (x, label, draws) rows on a feature; None without one that gains."""
    found = _score(rows) * (1 + 1e-9), None
    for t in thresholds:
        sides = [r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]
        if min(sum(_counts(s)) for s in sides) >= max(1, leaf) and _score(*sides) > found[0]:
            found = _score(*sides), t
    return found


def test_bins():
    x = np.stack([np.arange(1000) ** 2, np.arange(1000) % 32, np.arange(1000) % 33, np.where(np.arange(1000) < 990, 5, np.arange(1000))], axis=1) / 4
    rows, at = _coded(x, np.zeros(1000)), np.arange(0, 1000, 2)
    got = growth.binned(rows, at)
    assert [len(t) for t in got.thresholds] == [31, 15, 31, 5]
    assert all((got.codes[:, f] == (x[:, f][:, None] > got.thresholds[f]).sum(axis=1)).all() for f in range(4))
    even = np.bincount(got.codes[at, 0])
    assert len(even) == 32 and even.min() >= 15 and even.max() <= 17
    assert got.thresholds[1].tolist() == [v / 4 + 0.25 for v in range(0, 30, 2)]


@pytest.mark.parametrize("dense", [0, 0.25, 1e9])
@pytest.mark.parametrize("leaf, split, depth, features, values", [
    (1, 2, 30, 1, 40), (3, 2, 30, 1, 9), (1, 8, 4, 1, 40), (2, 2, 30, 4, 7), (1, 2, 5, 4, 1000)])
def test_every_cut_is_the_best(monkeypatch, leaf, split, depth, features, values, dense):
    monkeypatch.setattr(growth, "DENSE", dense)
    rng = np.random.default_rng(leaf + split)
    x, label = rng.integers(0, values, (150, features)) / 4, rng.integers(0, 3, 150)
    weight = rng.poisson(1.0, 150)
    rows = growth.binned(_coded(x, label), np.arange(150))
    thresholds = rows.thresholds
    tree = growth.grow(rows, np.arange(150), weight, rng, depth=depth, leaf=leaf, split=split)
    todo, seen = [(0, 0, [(x[i], label[i], weight[i]) for i in range(150) if weight[i]])], 0
    while todo:
        at, level, rows = todo.pop()
        seen += 1
        counts = _counts(rows)
        assert counts == tree.counts[at].tolist()
        if tree.left[at] < 0:
            may = level < depth and sum(counts) >= split and max(counts) < sum(counts)
            assert not may or features > 1 or _best(rows, 0, leaf, thresholds[0])[1] is None
            continue
        f, t = tree.feature[at], tree.threshold[at]
        sides = [r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]
        assert _score(*sides) == pytest.approx(_best(rows, f, leaf, thresholds[f])[0]) and min(sum(_counts(s)) for s in sides) >= leaf
        assert level < depth and sum(counts) >= split
        todo += [(tree.left[at] + k, level + 1, s) for k, s in enumerate(sides)]
    assert seen == len(tree.left) > 3


def test_ways_to_look_for_cuts_agree(monkeypatch):
    rng = np.random.default_rng(1)
    rows = growth.binned(_coded(rng.normal(size=(3000, 20)), rng.integers(0, 3, 3000)), np.arange(3000))
    grown = []
    for places, counts, dense in ((1, 1, 0), (1, 1, 1e9), (1 << 20, 1 << 20, 0.25), (1 << 9, 1 << 9, 0.25)):
        for name, value in (("PLACES_TOGETHER", places), ("COUNTS_TOGETHER", counts), ("DENSE", dense)):
            monkeypatch.setattr(growth, name, value)
        grown.append(growth.grow(rows, np.arange(3000), np.ones(3000), np.random.default_rng(2), depth=30, leaf=2))
    for other in grown[1:]:
        assert all((a == b).all() for a, b in zip(vars(grown[0]).values(), vars(other).values()) if isinstance(a, np.ndarray))


def test_huge_and_missing_values_are_cut():
    x = np.array([[-np.inf], [-1e308], [1e308], [np.inf], [np.nan], [np.nan]])
    rows = growth.binned(_coded(x, np.array([0, 1, 0, 1, 2, 2])), np.arange(6))
    tree = growth.grow(rows, np.arange(6), np.ones(6), np.random.default_rng(0), depth=30)
    assert (tree.counts[tree.left < 0].max(axis=1) == tree.counts[tree.left < 0].sum(axis=1)).all()
    assert not np.isnan(tree.threshold).any()


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    x, fold = rng.normal(size=(600, 9)), rng.integers(0, 3, 600)
    label = np.where(rng.random(600) < 0.4, rng.integers(0, 3, 600), (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5))
    made = spark.createDataFrame([(i, int(label[i]), x[i].tolist(), int(fold[i])) for i in range(600)], "id long, code int, x array<double>, fold int")
    ready = made.select("id", "code", array_to_vector("x").alias("features"), "fold")
    return training_table(ready, "id", "code", 3, "fold").persist()


def test_votes_are_those_of_the_trees(spark, noisy):
    """Every rule, against the trees followed one by one; held-out rows and rows learned from are told apart."""
    rows = growth.coded_rows(noisy, fold=F.col("fold"))
    x = np.stack([v[c] for v, c in zip(rows.values, rows.codes.T)], axis=1)
    train, rules = rows.more["fold"] != 0, [Rule(n, d, s) for n in (2, 30) for d in (1, 4, 30) for s in (2, 9)]
    [told] = growth.judge(spark, rows, [growth.Fit(train, np.ones(600, dtype=bool), rules, 2)], 7)
    trees = [t for _, _, t in growth._trees(rows, growth.Fit(train, train, rules, 2), 0, 30, 7)]
    for rule, found in zip(rules, told):
        votes = np.zeros((600, 3))
        for tree in trees[:rule.trees]:
            for i in range(600):
                at, level = 0, 0
                while tree.left[at] >= 0 and level < rule.depth and tree.counts[at].sum() >= rule.split:
                    at, level = tree.left[at] + int(x[i, tree.feature[at]] > tree.threshold[at]), level + 1
                votes[i] += tree.counts[at] / tree.counts[at].sum()
        right = votes.argmax(axis=1) == rows.label
        assert found == (int(train.sum()), int(right[train].sum()), int((~train).sum()), int(right[~train].sum()))


def test_out_of_bag_rows_only(spark, noisy):
    """Bags are those of the column expression, and a tree votes for the rows it did not draw."""
    rows, every = growth.coded_rows(noisy, bag_key=F.col("id").cast("string")), np.ones(600, dtype=bool)
    drawn = np.array([r.b for r in noisy.select(F.array(*[curves.bag_weight(t, "id", 7) for t in range(7)]).alias("b")).collect()])
    fit = growth.Fit(every, every, [Rule(n, 30, 2) for n in (2, 7)])
    [told], votes = growth.judge(spark, rows, [fit], 7), np.zeros((600, 3))
    for k, (own, undrawn, tree) in enumerate(growth._trees(rows, fit, 0, 7, 7)):
        out = np.flatnonzero(drawn[:, k] == 0)
        assert out.tolist() == undrawn.tolist() and tree.counts[0].sum() == drawn[:, k].sum()
        end = growth._ends(own, tree, out)
        votes[out] += tree.counts[end] / tree.counts[end].sum(axis=1, keepdims=True)
        if k in (1, 6):
            voted = (drawn[:, :k + 1] == 0).any(axis=1)
            assert told[0 if k == 1 else 1] == (voted.sum(), (votes.argmax(axis=1) == rows.label)[voted].sum(), 0, 0)


def test_model_votes_and_is_saved(spark, noisy, tmp_path):
    rows, every = growth.coded_rows(noisy), np.ones(600, dtype=bool)
    params = {"n_estimators": 30, "max_depth": 6, "min_samples_leaf": 2}
    model = grow_forest(spark, rows, params, 7)
    [[found]] = growth.judge(spark, rows, [growth.Fit(every, every, [Rule(30, 6, 2)], 2)], 7)
    scored = model.transform(noisy)
    assert scored.columns == [*noisy.columns, "probability", "prediction"]
    assert found[:2] == (600, scored.where("prediction = label").count()) and found[1] > 400
    PipelineModel([model]).write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    p = vector_to_array("probability")
    got, want = ({r.id: (r.p, r.prediction) for r in m.transform(noisy).select("id", p.alias("p"), "prediction").collect()} for m in (again, model))
    assert got == want and all(sum(p) == pytest.approx(1.0) and p.index(max(p)) == g for p, g in got.values())


def test_seed_and_layout(spark, noisy):
    """The same table in other partitions is placed by its key again, so the trees are the same; another seed gives others."""
    trees = []
    for df, seed in ((noisy, 7), (noisy.repartition(5), 7), (noisy, 8)):
        table = training_table(df.select("id", F.col("label").alias("code"), "features", "fold"), "id", "code", 3, "fold")
        model = grow_forest(spark, growth.coded_rows(table), {"n_estimators": 3})
        model = model if seed == 7 else grow_forest(spark, growth.coded_rows(table), {"n_estimators": 3}, seed)
        trees.append(sorted(tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r) for r in model.trees_table.collect()))
    assert trees[0] == trees[1] != trees[2]


def test_larger_tables_go_to_the_library(noisy, monkeypatch):
    grid = {"model__n_estimators": [3, 5], "model__max_depth": [2, None], "model__min_samples_split": [2], "model__min_samples_leaf": [1]}
    found = {}
    for cells in (growth.CELLS_IN_TASK, 600 * 9 - 1):
        monkeypatch.setattr(growth, "CELLS_IN_TASK", cells)
        search = grid_search(noisy, grid=grid, folds=3)
        found[type(search.model).__name__] = [r.n for r in search.scores.groupBy("candidate_id").agg(F.sum("n_rows").alias("n")).collect()]
        assert accuracies(noisy, [search.model])[0] > 0.5 if cells < 600 * 9 else search.model.transform(noisy).count() == 600
        assert search.n_fits == 4 and 0.4 < search.best_score < 1
        curve = curves.oob_curve(noisy, "id", {"n_estimators": 5}).first()
        assert curve.n_scored + curve.n_unscored == 600
    assert found == {"GrownForestModel": [600] * 4, "ForestModel": [600] * 4}
