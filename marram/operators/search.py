"""Grid search over folds, with its result table."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marram.functions.text import strip_prefix
from marram.operators.forest import (
    DEFAULT_GRID, build_forest, fit_forest, forest_settings, grow_forest, in_parallel, param_grid, rule_of,
)
from marram.operators.growth import CodedRows, Fit, coded_rows, fits_in_tasks, judge
from marram.operators.grown import GrownForestModel
from marram.operators.splits import DEFAULT_SEED
from marram.operators.trees import NodeArrays, hits_by_rule, node_table, saved, with_folder


@dataclass
class SearchResult:
    scores: DataFrame  # (candidate_id, fold, n_rows, score): a small table
    candidates: DataFrame  # (candidate_id, parameter, value)
    results: DataFrame  # one row per candidate
    best_params: dict
    best_score: float
    model: RandomForestClassificationModel | GrownForestModel | None
    n_fits: int


def cv_results(scores: DataFrame, folds: int, *, candidate: str = "candidate_id", fold: str = "fold",
               score: str = "score") -> DataFrame:
    """Per candidate: each fold's score, mean, population std, and rank (ties share the best rank)."""
    per_fold = [
        F.max(F.when(F.col(fold) == i, F.col(score))).alias(f"split{i}_test_score") for i in range(folds)
    ]
    table = scores.groupBy(candidate).agg(
        *per_fold, F.avg(score).alias("mean_test_score"), F.stddev_pop(score).alias("std_test_score")
    )
    return rank_candidates(table, candidate=candidate)


def rank_candidates(table: DataFrame, *, candidate: str = "candidate_id", mean: str = "mean_test_score") -> DataFrame:
    """Rank by mean, best first. The table holds candidates, not data, so one ordering suffices."""
    ordered = Window.partitionBy(F.lit(1)).orderBy(F.desc(mean))
    return table.withColumn("rank_test_score", F.rank().over(ordered).cast("long"))


def best_candidate(table: DataFrame, *, candidate: str = "candidate_id", mean: str = "mean_test_score") -> DataFrame:
    """The highest mean; among equals the first of the grid."""
    return table.orderBy(F.desc(mean), F.asc(candidate)).limit(1)


def parameter_table(df: DataFrame, name: str = "parameter") -> DataFrame:
    """Parameter names as they are reported: without the pipeline prefix."""
    return df.withColumn(name, strip_prefix(F.col(name)))


def grid_search(
    prepared: DataFrame,
    *,
    grid: Mapping[str, Iterable] | None = None,
    folds: int = 5,
    seed: int = DEFAULT_SEED,
    parallelism: int = 8,
    refit: bool = True,
    preprocess: Pipeline | None = None,
) -> SearchResult:
    """Search on a table of (label, features, fold), best cached by the caller.

    `preprocess` is for stages that learn from the rows, such as scaling: it is fitted on each
    training fold anew, so held-out rows never leak into it. Leave it out when `features` is ready.

    Candidates that differ only in trees, depth or least split are read off one forest, grown once per fold and least
    leaf with the most trees and the greatest depth among them; all are judged in one pass over the held-out rows.
    So there are folds x least leaves fits, side by side, and one more for the winner. Only scores reach the driver.

    Trees are grown and judged inside tasks where these can hold the table, else by the library.
    """
    spark = prepared.sparkSession
    candidates = param_grid(grid or DEFAULT_GRID)
    rules = [rule_of(c) for c in candidates]
    by_leaf: dict[int, list[int]] = {}
    for i, c in enumerate(candidates):
        by_leaf.setdefault(forest_settings(c)["minInstancesPerNode"], []).append(i)

    def judged(fold: int, leaf: int, folder: str) -> list[tuple[int, int, int, float | None]]:
        own = by_leaf[leaf]
        train, held = prepared.where(F.col("fold") != fold), prepared.where(F.col("fold") == fold)
        if preprocess is not None:
            stages = preprocess.fit(train)
            train, held = stages.transform(train), stages.transform(held)
        grown = build_forest(seed, numTrees=max(rules[i].trees for i in own), maxDepth=max(rules[i].depth for i in own),
                             minInstancesPerNode=leaf).fit(train)
        nodes = NodeArrays(node_table(spark, saved(grown, folder)))
        found = hits_by_rule(held, nodes, [rules[i] for i in own])
        return [(i, fold, n, hits / n if n else None) for i, (n, hits) in zip(own, found)]

    def judged_in_tasks(rows: CodedRows, calls: list[tuple[int, int]]) -> list[list[tuple[int, int, int, float | None]]]:
        at = rows.more["fold"]
        told = judge(spark, rows, [Fit(at != fold, at == fold, [rules[i] for i in by_leaf[leaf]], leaf) for fold, leaf in calls], seed)
        return [[(i, fold, n, hits / n if n else None) for i, (_, _, n, hits) in zip(by_leaf[leaf], found)]
                for (fold, leaf), found in zip(calls, told)]

    whole = preprocess.fit(prepared).transform(prepared) if preprocess is not None else prepared
    in_tasks = fits_in_tasks(whole)
    coded = coded_rows(whole, fold=F.col("fold")) if in_tasks else None
    calls = [(fold, leaf) for fold in range(folds) for leaf in by_leaf]
    if not in_tasks:
        got = with_folder(spark, lambda folder: in_parallel(
            spark, [lambda f=f, m=m: judged(f, m, folder) for f, m in calls], parallelism))
    elif preprocess is None:
        got = judged_in_tasks(coded, calls)
    else:
        got = []
        for fold in range(folds):
            own = preprocess.fit(prepared.where(F.col("fold") != fold)).transform(prepared)
            got += judged_in_tasks(coded_rows(own, fold=F.col("fold")), [c for c in calls if c[0] == fold])
    rows = sorted(r for each in got for r in each)
    scores = spark.createDataFrame(rows, "candidate_id int, fold int, n_rows long, score double")
    named = parameter_table(spark.createDataFrame(
        [(i, n, json.dumps(v)) for i, c in enumerate(candidates) for n, v in c.items()],
        "candidate_id int, parameter string, value string",
    ))
    results = cv_results(scores, folds)
    best = best_candidate(results).first()
    chosen = candidates[best.candidate_id]
    model = None
    if refit:
        model = grow_forest(spark, coded, chosen, seed) if in_tasks else fit_forest(whole, chosen, seed)
    clean = {n.removeprefix("model__"): v for n, v in chosen.items()}
    return SearchResult(scores, named, results, clean, best.mean_test_score, model, len(calls) + refit)
