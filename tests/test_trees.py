"""Trees as tables against plain Python on the saved nodes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marram.functions.features import encode_label
from marram.operators import curves, trees
from marram.operators.forest import (
    DEFAULT_GRID, accuracies, build_forest, fit_forest, forest_settings, least_split, param_grid, training_table,
)
from marram.operators.preprocess import preprocessing_pipeline
from marram.schema import FLOWERS
from marram.session import drop_path


@pytest.fixture(scope="module")
def prepared(flowers):
    # A third of the classes is turned, so that trees grow deep.
    noisy = flowers.withColumn("code", F.pmod(encode_label(F.col("species"), FLOWERS.codes) + (F.col("row_key") % 7 == 0).cast("int"), F.lit(3)))
    ready = preprocessing_pipeline(FLOWERS).fit(noisy).transform(noisy)
    return training_table(ready, "row_key", "code", 3).persist()


@pytest.fixture(scope="module")
def grown(spark, prepared, tmp_path_factory):
    model = build_forest(numTrees=6, maxDepth=30).fit(prepared)
    path = trees.saved(model, str(tmp_path_factory.mktemp("forest")))
    nodes = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    return model, path, nodes


@pytest.fixture(scope="module")
def rows(prepared):
    return [(r.row_key, int(r.label), r.x) for r in prepared.select("row_key", "label", vector_to_array("features").alias("x")).collect()]


def _vote(tree, x, depth, split):
    at, level = tree[0], 0
    while at.leftChild >= 0 and level < depth and at.rawCount >= split:
        at = tree[at.leftChild if x[at.split.featureIndex] <= at.split.leftCategoriesOrThreshold[0] else at.rightChild]
        level += 1
    return np.array(at.impurityStats) / sum(at.impurityStats)


def test_every_setting_by_brute_force(spark, prepared, grown, rows):
    model, path, nodes = grown
    rules = [trees.Rule(n, depth, split) for n in (1, 3, 6) for depth in (1, 3, 30) for split in (2, 5, 12)]
    found = trees.hits_by_rule(prepared, trees.NodeArrays(trees.node_table(spark, path)), rules)
    for rule, (n, hits) in zip(rules, found):
        right = sum(int(np.argmax(sum(_vote(nodes[t], x, rule.depth, rule.split) for t in range(rule.trees)))) == y for _, y, x in rows)
        assert (n, hits) == (len(rows), right)
    whole = dict(zip(rules, found))[trees.Rule(6, 30, 2)]
    assert whole[1] / whole[0] == accuracies(prepared, [model])[0]


@pytest.mark.parametrize("split", [2, 5, 9, 40, 1000])
def test_least_split_is_exact(spark, prepared, grown, rows, tmp_path, split):
    model, _, nodes = grown
    cut = trees.split_limited(spark, model, split, str(tmp_path))
    got = {r.row_key: r.p for r in cut.transform(prepared).select("row_key", vector_to_array("probability").alias("p")).collect()}
    for key, _, x in rows:
        assert got[key] == pytest.approx(sum(_vote(t, x, 30, split) for t in nodes.values()) / len(nodes))
    assert cut.getNumTrees == 6 and (split < 1000 or cut.totalNumNodes == 6)


def test_default_candidates_are_all_different():
    rules = {(*forest_settings(c).values(), least_split(c)) for c in param_grid(DEFAULT_GRID)}
    assert len(rules) == 48


def test_fitted_forest_has_no_small_cut(spark, prepared, tmp_path):
    model = fit_forest(prepared, {"n_estimators": 3, "min_samples_split": 9})
    path = trees.saved(model, str(tmp_path))
    inner = spark.read.parquet(f"{path}/data").where("nodeData.leftChild >= 0")
    assert inner.count() > 0 and inner.where("nodeData.rawCount < 9").count() == 0


def test_out_of_bag_votes_by_brute_force(spark, prepared, grown, rows):
    _, path, nodes = grown
    outside = F.array(*[curves.bag_weight(t, "row_key") == 0 for t in range(6)])
    out = {r.row_key: r.out for r in prepared.select("row_key", outside.alias("out")).collect()}
    found = trees.votes_out_of_bag(prepared, trees.NodeArrays(trees.node_table(spark, path)), outside, [2, 5, 6], split=4)
    for size, got in zip([2, 5, 6], found):
        voted = [(y, sum(_vote(nodes[t], x, 30, 4) for t in range(size) if out[k][t])) for k, y, x in rows if any(out[k][:size])]
        assert got == (len(voted), sum(int(np.argmax(v)) == y for y, v in voted))


def test_scratch_folders_are_removed(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x")
    drop_path(spark, f"{tmp_path}/x")
    assert not (tmp_path / "x").exists()
