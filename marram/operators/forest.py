"""Random-forest settings, and training tables that give the same forest on any cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.functions.hashing import seeded_md5
from marram.operators.growth import CodedRows, grown_trees
from marram.operators.grown import GrownForestModel
from marram.operators.splits import DEFAULT_SEED
from marram.operators.trees import Rule, split_limited, with_folder
from marram.session import ensure_checkpoint_dir

DEFAULT_TREES = 100  # fixed value: trees of an untuned forest
ROWS_PER_PARTITION = 100_000  # of training tables
TRAIN_ROWS = 1000  # the documented bound on labelled rows that registered queries fit forests on
DEEPEST = 30  # the library's depth limit stands for "no limit"

# The default search space.
DEFAULT_GRID = {
    "model__n_estimators": [50, 100, 200],
    "model__max_depth": [3, 4, 5, None],
    "model__min_samples_split": [2, 5],
    "model__min_samples_leaf": [1, 2],
}


def param_grid(grid: Mapping[str, Iterable]) -> list[dict]:
    """All combinations in a fixed order: names sorted, the last name varies fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in product(*[list(grid[n]) for n in names])]


def _param(params: Mapping[str, object], name: str, default: object) -> object:
    return params.get(f"model__{name}", params.get(name, default))


def forest_settings(params: Mapping[str, object]) -> dict[str, int]:
    """Search parameters in Spark's terms, but for the least size of a node that is cut (`least_split`)."""
    depth = _param(params, "max_depth", None)
    return {
        "numTrees": int(_param(params, "n_estimators", DEFAULT_TREES)),
        "maxDepth": DEEPEST if depth is None else min(int(depth), DEEPEST),
        "minInstancesPerNode": int(_param(params, "min_samples_leaf", 1)),
    }


def least_split(params: Mapping[str, object]) -> int:
    """Rows a node must hold to be cut. The library has no such setting; it is applied to the grown trees."""
    return int(_param(params, "min_samples_split", 2))


class ForestModel(RandomForestClassificationModel):
    """The library's model; `trees` is read on request only.

    As a cached attribute it is taken for a parameter, and every parameter lookup then wraps all
    trees in Python objects, which costs more than fitting small forests.
    """

    @property
    def trees(self) -> list:
        return RandomForestClassificationModel.trees.func(self)


class Forest(RandomForestClassifier):
    def _create_model(self, java_model) -> ForestModel:
        return ForestModel(java_model)


def build_forest(seed: int = DEFAULT_SEED, *, features_col: str = "features", label_col: str = "label",
                 **settings: object) -> Forest:
    deep = int(settings.get("maxDepth", 5)) > 10
    return Forest(
        featuresCol=features_col, labelCol=label_col, seed=seed, impurity="gini",
        featureSubsetStrategy="sqrt", cacheNodeIds=deep, checkpointInterval=10,
        **{"numTrees": DEFAULT_TREES, **settings},
    )


def label_column(df: DataFrame, label: str, classes: int | None = None):
    """The class code as ML wants it; a declared class count spares a job per fit."""
    coded = quoted(label).cast("double")
    if classes is None:
        return coded.alias("label")
    return coded.alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})


def training_table(df: DataFrame, key: str, label: str, classes: int | None, *keep: str,
                   features_col: str = "features") -> DataFrame:
    """(key, label, features, keep…) placed and ordered by key.

    Forests depend on how rows lie in partitions even under a fixed seed. Placement by key over a
    number of partitions that follows from the row count alone makes the fit a function of the
    data, on any cluster; small tables also stay in few tasks, so many fits run side by side.
    """
    ensure_checkpoint_dir(df.sparkSession)
    narrow = df.select(quoted(key), label_column(df, label, classes), F.col(features_col), *keep)
    parts = max(1, -(-df.count() // ROWS_PER_PARTITION))
    return narrow.repartition(parts, quoted(key)).sortWithinPartitions(quoted(key))


def fitted_rows(df: DataFrame, key: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows that come first by digest of their key: the same ones on any cluster.

    They are written, so the table is read once, however many passes a fit, a split or a search takes over them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.orderBy(seeded_md5(DEFAULT_SEED, quoted(key)), quoted(key)).limit(rows).checkpoint()


def in_parallel(spark: SparkSession, calls: Iterable[Callable[[], object]], workers: int) -> list:
    """Run independent driver calls side by side, so small fits fill the cluster together."""
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = [pool.submit(wrap(call)) for call in calls]
        return [f.result() for f in futures]


def fit_forest(train: DataFrame, params: Mapping[str, object], seed: int = DEFAULT_SEED) -> ForestModel:
    """A forest under search parameters. Nodes below the least split are made leaves after the fit."""
    settings, split = forest_settings(params), least_split(params)
    model = build_forest(seed, **settings).fit(train)
    if split <= 2 * settings["minInstancesPerNode"]:
        return model  # a node that small has no two children that are large enough
    spark = train.sparkSession
    return with_folder(spark, lambda folder: split_limited(spark, model, split, folder))


def rule_of(params: Mapping[str, object]) -> Rule:
    settings = forest_settings(params)
    return Rule(settings["numTrees"], settings["maxDepth"], least_split(params))


def grow_forest(spark: SparkSession, rows: CodedRows, params: Mapping[str, object], seed: int = DEFAULT_SEED) -> GrownForestModel:
    """A forest under search parameters, grown inside tasks on coded rows."""
    ensure_checkpoint_dir(spark)
    trees = grown_trees(spark, rows, rule_of(params), forest_settings(params)["minInstancesPerNode"], seed)
    return GrownForestModel(trees, rows.classes)


def add_predictions(df: DataFrame, models: list, prefix: str = "__p") -> DataFrame:
    """Predictions of many models side by side in one pass over the rows."""
    for i, model in enumerate(models):
        own = model.copy().setPredictionCol(f"{prefix}{i}").setProbabilityCol("").setRawPredictionCol("")
        df = own.transform(df)
    return df


def accuracies(df: DataFrame, models: list) -> list[float]:
    """Accuracy of each model on the table; one job for all."""
    scored = add_predictions(df, models)
    row = scored.agg(*[
        F.avg((F.col(f"__p{i}") == F.col("label")).cast("double")).alias(f"a{i}") for i in range(len(models))
    ]).first()
    return [row[f"a{i}"] for i in range(len(models))]
