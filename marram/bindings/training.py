"""Forests on the embedding table: fit, search, curves, and the whole train-evaluate run.

Forests are not another library's, so SQL checks what does not depend on them: which rows are fitted, scored and left out,
how many candidates, folds and sizes there are, and that scores, ranks and classes are possible ones.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.bindings.data import FOLD_SQL, SPLIT_SQL
from marram.bindings.registry import load, query
from marram.operators import curves, search
from marram.operators.forest import TRAIN_ROWS, build_forest, fit_forest, fitted_rows, training_table
from marram.operators.splits import stratified_kfold, stratified_split, with_prefix_steps
from marram.plans.train_evaluate import TrainEvaluate
from marram.session import scratch_path
from marram.sources import sinks
from marram.sources.sinks import load_model, save_model

CLASSES = 10


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("code"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def folded_vectors(spark: SparkSession, sf_dir: str, folds: int = 5, steps: bool = False) -> DataFrame:
    folded = stratified_kfold(fitted_rows(vectors(spark, sf_dir), "vec_id"), "vec_id", "code", folds=folds)
    keep = ["fold"]
    if steps:
        folded = with_prefix_steps(folded, "vec_id", "fold", folds)
        keep.append("prefix_steps")
    return training_table(folded, "vec_id", "code", CLASSES, *keep).persist()


# The rows that are fitted, and the shared split and folds over them or over all rows.
ALL_SQL = "(select vec_id, label as code from embeddings) v"
BOUNDED_SQL = f"(select vec_id, label as code from embeddings order by md5('5901:' || vec_id), vec_id limit {TRAIN_ROWS}) v"


def _over(sql: str, rows: str) -> str:
    return sql.replace("from orders", f"from {rows}").replace("o_orderkey", "vec_id").replace("o_orderstatus", "code")


def unlikely(chances: Column) -> Column:
    """Whether class chances are no distribution."""
    total = F.aggregate(chances, F.lit(0.0), lambda a, x: a + x)
    return (F.abs(total - 1.0) > 1e-9) | (F.array_min(chances) < 0)


@query("rf_train_predict", f"""
    select cast(code as integer) as code, count(*) as n_test, cast(0 as bigint) as n_unknown, cast(0 as bigint) as n_unlikely
    from ({_over(SPLIT_SQL, ALL_SQL)}) where split = 'test' group by 1
""")
def rf_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default forest, fitted on the training side, over all rows of the test side."""
    rows = stratified_split(vectors(spark, sf_dir), "vec_id", "code")
    train = training_table(fitted_rows(rows.where("split = 'train'"), "vec_id"), "vec_id", "code", CLASSES)
    scored = fit_forest(train, {}).transform(rows.where("split = 'test'")).withColumn("p", vector_to_array("probability"))
    known = F.col("prediction").isin([float(c) for c in range(CLASSES)])
    return scored.groupBy("code").agg(F.count(F.lit(1)).alias("n_test"), F.count_if(~known).alias("n_unknown"),
                                      F.count_if(unlikely(F.col("p"))).alias("n_unlikely"))


@query("model_roundtrip", """
    select cast(label as integer) as code, count(*) as n, cast(0 as bigint) as n_changed, cast(0 as bigint) as n_bad_sum from embeddings group by 1
""")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load: predictions must not change, and probabilities must sum to one."""
    rows = vectors(spark, sf_dir)
    table = training_table(fitted_rows(rows, "vec_id"), "vec_id", "code", CLASSES)
    fitted = PipelineModel([build_forest(numTrees=3, maxDepth=4).fit(table)])
    path = scratch_path(spark, "model_roundtrip", sf_dir)
    save_model(fitted, path, example=table.select("vec_id", "features"), key="vec_id")
    # Both models score a row where it lies, side by side.
    first = fitted.transform(rows).select("code", "features", F.col("prediction").alias("first"))
    again = load_model(path).transform(first).withColumn("p", vector_to_array("probability"))
    return again.groupBy("code").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") != F.col("prediction")).alias("n_changed"),
        F.count_if(unlikely(F.col("p"))).alias("n_bad_sum"))


@query("grid_search", f"""
    with candidates as (
        select cast(12 * d.i + 6 * l.i + 3 * s.i + n.i as integer) as candidate_id, d.v as max_depth, l.v as min_samples_leaf,
               s.v as min_samples_split, n.v as n_estimators
        from (values (0, '3'), (1, '4'), (2, '5'), (3, 'null')) d(i, v), (values (0, '1'), (1, '2')) l(i, v),
             (values (0, '2'), (1, '5')) s(i, v), (values (0, '50'), (1, '100'), (2, '200')) n(i, v))
    select *, cast(5 as bigint) as n_folds, (select count(*) from {BOUNDED_SQL}) as n_held, cast(0 as bigint) as n_impossible,
           cast(0 as bigint) as rank_gap, cast(11 as integer) as n_fits
    from candidates
""")
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default 48 candidates on 5 folds, with the winner fitted again."""
    table = folded_vectors(spark, sf_dir)
    found = search.grid_search(table)
    table.unpersist()
    held = found.scores.groupBy("candidate_id").agg(
        F.count(F.lit(1)).alias("n_folds"), F.sum("n_rows").alias("n_held"),
        F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("n_impossible"))
    names = found.candidates.groupBy("candidate_id").pivot(
        "parameter", ["max_depth", "min_samples_leaf", "min_samples_split", "n_estimators"]).agg(F.first("value"))
    one, two = found.results.alias("a"), found.results.alias("b")
    better = one.join(two, F.col("b.mean_test_score") > F.col("a.mean_test_score"), "left").groupBy(
        "a.candidate_id", "a.rank_test_score").agg(F.count("b.candidate_id").alias("n_better"))
    ranks = better.select("candidate_id", (F.col("rank_test_score") - 1 - F.col("n_better")).alias("rank_gap"))
    return names.join(held, "candidate_id").join(ranks, "candidate_id").withColumn("n_fits", F.lit(found.n_fits))


@query("learning_curve", f"""
    with k as ({_over(FOLD_SQL, BOUNDED_SQL)}), z as (select count(*) as n from k where fold <> 0)
    select cast(i as integer) as step, cast(floor(f * n) as bigint) as train_rows, cast(5 as bigint) as n_folds,
           cast(0 as bigint) as n_impossible
    from z, (values (1, 0.2e0), (2, 0.4e0), (3, 0.6e0), (4, 0.8e0), (5, 1.0e0)) s(i, f)
""")
def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default forest on five nested samples of each of 5 training folds."""
    table = folded_vectors(spark, sf_dir, steps=True)
    scores = curves.learning_curve_scores(table, {})
    table.unpersist()
    possible = F.col("train_score").between(0, 1) & F.col("validation_score").between(0, 1)
    return scores.groupBy("step").agg(
        F.min("train_rows").alias("train_rows"), F.count(F.lit(1)).alias("n_folds"),
        F.count_if(~F.coalesce(possible, F.lit(False))).alias("n_impossible"))


@query("oob_curve", f"""
    with bags as (
        select vec_id, t.i as tree, ('0x' || substr(md5('5901:' || t.i || ':' || vec_id), 1, 8))::bigint / 4294967296.0e0 < exp(-1) as out
        from {BOUNDED_SQL}, range(100) t(i)),
    firsts as (select vec_id, min(tree) filter (out) as tree from bags group by 1)
    select cast(s.n as integer) as n_trees, count(*) filter (tree < s.n) as n_scored,
           count(*) filter (tree is null or tree >= s.n) as n_unscored, true as possible
    from firsts, (select unnest(range(10, 101, 10)) as n) s group by s.n
""")
def oob_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default forest's out-of-bag error at ten sizes."""
    table = training_table(fitted_rows(vectors(spark, sf_dir), "vec_id"), "vec_id", "code", CLASSES).persist()
    curve = curves.oob_curve(table, "vec_id", {})
    table.unpersist()
    return curve.select("n_trees", "n_scored", "n_unscored", F.coalesce(F.col("oob_error").between(0, 1), F.lit(True)).alias("possible"))


@query("train_evaluate", f"""
    with s as ({_over(SPLIT_SQL, ALL_SQL)}), t as (select count(*) as n from s where split = 'test'),
    c as (select code, count(*) as n from s where split = 'test' group by 1)
    select 'best_params' as part, cast(4 as bigint) as n
    union all select 'candidates', 48 * 4 union all select 'cv_results', 48 union all select 'learning_curve', 5
    union all select 'oob_curve', 10 union all select 'held_out', n from t union all select 'changed', 0
    union all select 'auc', count(*) from c union all select 'support ' || code, n from c
""")
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over all rows: split, 48 x 5 search, refit, curves, model; then the same rows judged again from the saved model."""
    run = TrainEvaluate(key="vec_id", label="code", classes=CLASSES, root=scratch_path(spark, "train_evaluate", sf_dir), run_id="bench")
    rows = vectors(spark, sf_dir)
    again = run.evaluate(spark, rows, run.train(rows))
    part = lambda side, name: spark.read.json(f"{run.folder}/{side}/{name}")
    sized = lambda name, df: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    results = spark.read.option("header", True).csv(f"{run.folder}/holdout/{sinks.CV_RESULTS}")
    first = part("holdout", sinks.METRICS).select(F.col("accuracy").alias("first"))
    report = part("eval", sinks.REPORT).where(F.col("label").rlike("^[0-9]+$"))
    tables = [
        *[sized(name, part("holdout", name)) for name in (sinks.BEST_PARAMS, "candidates", "learning_curve", "oob_curve")],
        sized("cv_results", results), sized("auc", part("eval", "auc").where("auc between 0 and 1")),
        again.select(F.lit("held_out").alias("part"), F.col("n_rows").alias("n")),
        again.crossJoin(first).select(F.lit("changed").alias("part"), (F.col("first") != F.col("accuracy")).cast("long").alias("n")),
        report.select(F.concat(F.lit("support "), "label").alias("part"), F.col("support").cast("long").alias("n")),
    ]
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole
