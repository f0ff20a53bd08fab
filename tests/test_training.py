from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marram.bindings import ORACLES, QUERIES
from marram.functions.features import encode_label
from marram.operators import curves
from marram.operators.forest import build_forest, fitted_rows, training_table
from marram.operators.preprocess import preprocessing_pipeline
from marram.operators.search import grid_search
from marram.operators.splits import stratified_kfold, with_prefix_steps
from marram.plans.train_evaluate import TrainEvaluate, predict_sample
from marram.schema import FLOWERS

GRID = {"model__n_estimators": [3, 5], "model__max_depth": [2, None], "model__min_samples_split": [2], "model__min_samples_leaf": [1, 2]}


@pytest.fixture(scope="module")
def prepared(flowers):
    coded = flowers.withColumn("code", encode_label(F.col("species"), FLOWERS.codes))
    folded = with_prefix_steps(stratified_kfold(coded, "row_key", "code", folds=3), "row_key", "fold", folds=3)
    ready = preprocessing_pipeline(FLOWERS).fit(folded).transform(folded)
    return training_table(ready, "row_key", "code", 3, "fold", "prefix_steps").persist()


def test_forest_ignores_layout(flowers):
    coded = flowers.withColumn("code", encode_label(F.col("species"), FLOWERS.codes))
    seen = set()
    for df in (coded.coalesce(1), coded.repartition(5)):
        ready = preprocessing_pipeline(FLOWERS).fit(df).transform(df)
        table = training_table(ready, "row_key", "code", 3)
        model = build_forest(numTrees=4, maxDepth=3).fit(table)
        out = model.transform(table).select("row_key", "prediction", F.col("probability").cast("string").alias("p"))
        seen.add(tuple(sorted(tuple(r) for r in out.collect())))
        assert len(model.trees) == 4
    assert len(seen) == 1


def test_search_table_and_winner(prepared):
    found = grid_search(prepared, grid=GRID, folds=3)
    rows = found.results.orderBy("candidate_id").collect()
    assert len(rows) == 8 and found.scores.count() == 24
    assert set(found.best_params) == {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf"}
    top = max(r.mean_test_score for r in rows)
    assert found.best_score == top and top > 0.8
    assert min(r.candidate_id for r in rows if r.mean_test_score == top) == [
        r.candidate_id for r in rows if r.rank_test_score == 1][0]
    assert {r.parameter for r in found.candidates.collect()} == set(found.best_params)


def test_learning_curve(prepared):
    scores = curves.learning_curve_scores(prepared, {"n_estimators": 3, "max_depth": 3}, folds=3)
    assert scores.count() == 15
    means = curves.learning_curve(scores).orderBy("step").collect()
    assert [r.train_rows for r in means] == [20, 40, 60, 80, 100]
    assert all(0 <= r.validation_mean <= 1 for r in means) and means[-1].train_mean > 0.9


def test_learning_curve_scales_each_sample(flowers):
    coded = flowers.withColumn("code", encode_label(F.col("species"), FLOWERS.codes)).withColumn("features", F.lit(None))
    folded = with_prefix_steps(stratified_kfold(coded, "row_key", "code", folds=3), "row_key", "fold", folds=3)
    raw = training_table(folded, "row_key", "code", 3, "fold", "prefix_steps", *FLOWERS.features).drop("features").persist()
    scores = curves.learning_curve_scores(raw, {"n_estimators": 3, "max_depth": 3}, folds=1, steps=5,
                                          preprocess=preprocessing_pipeline(FLOWERS, use_scaling=True))
    rows = scores.orderBy("step").collect()
    assert [r.train_rows for r in rows] == [20, 40, 60, 80, 100]
    assert all(0 <= r.validation_score <= 1 for r in rows) and rows[-1].train_score > 0.9


def test_ensemble_sizes():
    assert curves.ensemble_sizes(50) == list(range(5, 51, 5))
    assert curves.ensemble_sizes(200) == list(range(20, 201, 20))
    assert curves.ensemble_sizes(12) == [5, 10, 12] and curves.ensemble_sizes(3) == [3]


def test_bags_are_poisson(spark):
    weights = spark.range(20_000).select(curves.bag_weight(3, "id").alias("w"))
    row = weights.agg(F.avg("w").alias("m"), F.avg((F.col("w") == 0).cast("int")).alias("out")).first()
    assert row.m == pytest.approx(1.0, abs=0.03) and row.out == pytest.approx(0.3679, abs=0.015)


def test_oob_curve(prepared):
    curve = curves.oob_curve(prepared, "row_key", {"n_estimators": 12, "max_depth": 4}).orderBy("n_trees").collect()
    assert [r.n_trees for r in curve] == [5, 10, 12]
    assert all(r.n_scored + r.n_unscored == 150 and 0 <= r.oob_error <= 1 for r in curve)
    assert curve[0].n_unscored >= curve[-1].n_unscored and curve[-1].oob_error < 0.2


@pytest.mark.parametrize("scaling", [False, True])
def test_whole_run(spark, flowers, tmp_path, scaling):
    run = TrainEvaluate(key="row_key", table=FLOWERS, grid={"model__n_estimators": [3], "model__max_depth": [2, 3]}, folds=3,
                        root=str(tmp_path), run_id="r1", use_scaling=scaling, curves=not scaling)
    path = run.train(flowers)
    again = run.evaluate(spark, flowers.repartition(4), path).first()
    first = spark.read.json(f"{run.folder}/holdout/metrics").first()
    assert again.n_rows == 30 and again.accuracy == first.accuracy > 0.8
    assert first.best_n_estimators == 3 and first.use_scaling == scaling
    areas = spark.read.json(f"{run.folder}/eval/auc").collect()
    assert {r["class"] for r in areas} == set(FLOWERS.codes) and all(r.auc > 0.8 for r in areas)
    report = {r.label for r in spark.read.json(f"{run.folder}/eval/classification_report").collect()}
    assert report == {*FLOWERS.codes, "accuracy", "macro avg", "weighted avg"}
    assert spark.read.option("header", True).csv(f"{run.folder}/holdout/cv_results").count() == 2
    if not scaling:
        assert spark.read.json(f"{run.folder}/holdout/learning_curve").count() == 5
        assert spark.read.json(f"{run.folder}/holdout/oob_curve").count() == 1
    assert spark.read.parquet(f"{path}/input_example").count() == 1
    sample = spark.createDataFrame([(5.1, 3.5, 1.4, 0.2)], ", ".join(f"`{c}` double" for c in FLOWERS.features))
    guess = predict_sample(path, sample, FLOWERS.codes).first()
    assert guess.predicted_label == "setosa" and sum(guess.probability) == pytest.approx(1.0)


def test_fitted_rows_are_read_once(spark, tmp_path):
    spark.range(3000).selectExpr("id", "id % 3 as code").write.parquet(f"{tmp_path}/t")
    rows = fitted_rows(spark.read.parquet(f"{tmp_path}/t"), "id")
    assert "parquet" not in rows._jdf.queryExecution().toString().lower() and rows.count() == 1000


def test_whole_job_takes_all_rows(spark, tmp_path):
    rows = spark.range(1500).selectExpr("id as vec_id", "cast(id % 10 as int) as label", "cast(id % 10 + (id * 7919 % 100) / 60 as float) as x")
    rows.selectExpr("vec_id", "array(x, -x, cast(vec_id % 13 as float), x * x) as embedding", "label").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    found = {r.part: r.n for r in QUERIES["train_evaluate"](spark, str(tmp_path)).collect()}
    assert found["held_out"] == 300 and found["changed"] == 0
    assert [found[f"support {c}"] for c in range(10)] == [30] * 10
    assert "limit" not in ORACLES["train_evaluate"]
