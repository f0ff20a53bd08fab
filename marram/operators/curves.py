"""Learning curve and out-of-bag error curve of a forest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.functions.hashing import poisson_one, unit_interval
from marram.operators.forest import (
    accuracies, add_predictions, build_forest, fit_forest, forest_settings, in_parallel, least_split, rule_of,
)
from marram.operators.growth import Fit, coded_rows, fits_in_tasks, judge
from marram.operators.splits import DEFAULT_SEED
from marram.operators.trees import NodeArrays, Rule, node_table, saved, votes_out_of_bag, with_folder


SCORES = "fold int, step int, train_rows long, train_score double, validation_score double"


def learning_curve_scores(
    prepared: DataFrame,
    params: Mapping[str, object],
    *,
    folds: int = 5,
    steps: int = 5,
    seed: int = DEFAULT_SEED,
    parallelism: int = 8,
    preprocess: Pipeline | None = None,
) -> DataFrame:
    """(fold, step, train_rows, train_score, validation_score) from (label, features, fold, prefix_steps).

    `preprocess` is for stages that learn from the rows: it is fitted on each sample anew, so held-out
    rows never shape it. Leave it out when `features` is ready; then one pass judges all samples.
    """
    spark = prepared.sparkSession
    if preprocess is None and fits_in_tasks(prepared):
        return _scores_in_tasks(prepared, params, folds, steps, seed)
    rows = []
    for fold in range(folds):
        first_step = F.col("prefix_steps")[fold]
        samples = [prepared.where(first_step <= step) for step in range(1, steps + 1)]
        held = prepared.where(F.col("fold") == fold)
        if preprocess is None:
            models = in_parallel(spark, [lambda s=s: fit_forest(s, params, seed) for s in samples], parallelism)
            valid = accuracies(held, models)
            train = _nested_accuracies(prepared.where(first_step.isNotNull()), first_step, models)
        else:
            judged = in_parallel(
                spark, [lambda s=s: _judge_sample(s, held, preprocess, seed, params) for s in samples], parallelism)
            train, valid = [j[:2] for j in judged], [j[2] for j in judged]
        rows += [(fold, i + 1, *train[i], valid[i]) for i in range(steps)]
    return prepared.sparkSession.createDataFrame(rows, SCORES)


def _scores_in_tasks(prepared: DataFrame, params: Mapping[str, object], folds: int, steps: int, seed: int) -> DataFrame:
    """The forests of all samples, grown and judged inside tasks."""
    first_step = F.transform(F.col("prefix_steps"), lambda s: F.coalesce(s, F.lit(steps + 1)))
    rows = coded_rows(prepared, fold=F.col("fold"), steps=first_step)
    rule, leaf = rule_of(params), forest_settings(params)["minInstancesPerNode"]
    calls = [(fold, step) for fold in range(folds) for step in range(1, steps + 1)]
    fits = []
    for fold, step in calls:
        sample = rows.more["steps"][:, fold] <= step
        fits.append(Fit(sample, sample | (rows.more["fold"] == fold), [rule], leaf))
    told = judge(prepared.sparkSession, rows, fits, seed)
    share = lambda hits, n: hits / n if n else None
    return prepared.sparkSession.createDataFrame(
        [(*call, n, share(hits, n), share(right, held)) for call, [(n, hits, held, right)] in zip(calls, told)], SCORES)


def _judge_sample(sample: DataFrame, held: DataFrame, preprocess: Pipeline, seed: int,
                  params: Mapping[str, object]) -> tuple[int, float, float]:
    """Rows, accuracy on the sample and accuracy on the held-out rows of one sample's own pipeline and forest."""
    stages = preprocess.fit(sample)
    own = stages.transform(sample)
    model = fit_forest(own, params, seed)
    return sample.count(), accuracies(own, [model])[0], accuracies(stages.transform(held), [model])[0]


def _nested_accuracies(df: DataFrame, first_step, models: list) -> list[tuple[int, float]]:
    """Rows and accuracy of model i on sample i; samples are nested, so one pass serves all."""
    df = add_predictions(df, models)
    aggs = []
    for i in range(len(models)):
        inside = first_step <= i + 1
        aggs.append(F.count_if(inside).alias(f"n{i}"))
        aggs.append(F.avg(F.when(inside, (F.col(f"__p{i}") == F.col("label")).cast("double"))).alias(f"a{i}"))
    row = df.agg(*aggs).first()
    return [(row[f"n{i}"], row[f"a{i}"]) for i in range(len(models))]


def learning_curve(scores: DataFrame) -> DataFrame:
    """Mean training and validation score per sample size."""
    return scores.groupBy("step").agg(
        F.min("train_rows").alias("train_rows"), F.avg("train_score").alias("train_mean"),
        F.avg("validation_score").alias("validation_mean"),
    )


def ensemble_sizes(trees: int) -> list[int]:
    """Sizes at which the error is read (fixed rule): every max(5, trees // 10), and the full forest."""
    step = max(5, trees // 10)
    sizes = list(range(step, trees + 1, step))
    return sizes if sizes and sizes[-1] == trees else [*sizes, trees]


def bag_weight(tree: int | Column, key: str, seed: int = DEFAULT_SEED) -> Column:
    """How often tree number `tree` draws a row: a Poisson(1) count that depends on the key alone."""
    number = F.lit(tree) if isinstance(tree, int) else tree
    return poisson_one(unit_interval(seed, number, quoted(key)))


def oob_curve(
    prepared: DataFrame,
    key: str,
    params: Mapping[str, object],
    *,
    seed: int = DEFAULT_SEED,
    parallelism: int = 8,
    sizes: Sequence[int] | None = None,
) -> DataFrame:
    """(n_trees, n_scored, n_unscored, oob_error) from (key, label, features).

    One tree per bag, weighted by a column expression. Its nodes are read back, and one pass over the rows follows each tree
    for the rows outside its bag only, adding its votes along the trees, so every ensemble size is read from the
    same forest. Rows without a vote are left out and counted. Trees are grown inside tasks where these can hold the table.
    """
    spark, settings = prepared.sparkSession, forest_settings(params)
    trees = settings.pop("numTrees")
    sizes = list(sizes or ensemble_sizes(trees))

    def judged_in_tasks() -> list[tuple[int, int]]:
        rows = coded_rows(prepared, bag_key=quoted(key).cast("string"))
        every = np.ones(len(rows.label), dtype=bool)
        rules = [Rule(n, settings["maxDepth"], least_split(params)) for n in sizes]
        return [told[:2] for told in judge(spark, rows, [Fit(every, every, rules, settings["minInstancesPerNode"])], seed)[0]]

    def grown(tree: int, folder: str) -> str:
        bag = prepared.withColumn("__w", bag_weight(tree, key, seed).cast("double")).where(F.col("__w") > 0)
        return saved(build_forest(seed + tree, numTrees=1, bootstrap=False, weightCol="__w", **settings).fit(bag), folder)

    def judged(folder: str) -> list[tuple[int, int]]:
        paths = in_parallel(spark, [lambda t=t: grown(t, folder) for t in range(trees)], parallelism)
        outside = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: bag_weight(t, key, seed) == 0)
        return votes_out_of_bag(prepared, NodeArrays(node_table(spark, *paths)), outside, sizes, least_split(params))

    found = judged_in_tasks() if fits_in_tasks(prepared) else with_folder(spark, judged)
    n_rows = prepared.count()
    return spark.createDataFrame(
        [(n, scored, n_rows - scored, 1.0 - hits / scored if scored else None) for n, (scored, hits) in zip(sizes, found)],
        "n_trees int, n_scored long, n_unscored long, oob_error double",
    )
