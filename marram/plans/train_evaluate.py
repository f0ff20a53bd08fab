"""Train and evaluate: split, search, judge, save; then reload and judge again from the seed."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.features import decode_label, quoted, with_label_code
from marram.operators import curves as curve_ops
from marram.operators import metrics, roc
from marram.operators.forest import training_table
from marram.operators.preprocess import preprocessing_pipeline
from marram.operators.search import SearchResult, grid_search
from marram.operators.splits import (
    DEFAULT_SEED, DEFAULT_TEST_SIZE, stratified_kfold, stratified_split, with_prefix_steps,
)
from marram.schema import MeasuredTable
from marram.sources import sinks


@dataclass
class TrainEvaluate:
    """One run. Input is a table with a unique key and either a measured table's columns or a
    ready `features` vector with an integer class code."""

    key: str
    root: str
    run_id: str
    table: MeasuredTable | None = None
    label: str = "label_code"
    classes: int | None = None
    grid: Mapping[str, Iterable] | None = None
    folds: int = 5
    test_size: float = DEFAULT_TEST_SIZE
    data_seed: int = DEFAULT_SEED
    model_seed: int = DEFAULT_SEED
    use_scaling: bool = False
    parallelism: int = 8
    curves: bool = True
    data_input: str = "builtin_or_default"
    started: datetime = field(default_factory=datetime.now)

    @property
    def folder(self) -> str:
        return sinks.run_path(self.root, self.run_id, self.started)

    def train(self, df: DataFrame) -> str:
        """Run the search, write all result tables, and return the model's path."""
        rows = self._split(df)
        train = rows.where(F.col("split") == "train")
        folded = stratified_kfold(train, self.key, self.label, self.folds, self.data_seed)
        keep = ["fold"]
        if self.curves:
            folded = with_prefix_steps(folded, self.key, "fold", self.folds, seed=self.data_seed)
            keep.append("prefix_steps")

        stages = preprocessing_pipeline(self.table, self.use_scaling) if self.table else None
        per_fold = stages if self.use_scaling else None
        ready = stages.fit(train) if stages else None
        if per_fold is None:
            # Without fitted statistics the features are the same in every fold: build them once.
            built = ready.transform(folded) if ready else folded
            prepared = training_table(built, self.key, self.label, self._classes(), *keep)
        else:
            raw = folded.withColumn("features", F.lit(None))
            prepared = training_table(raw, self.key, self.label, self._classes(), *keep, *self.table.features)
            prepared = prepared.drop("features")
        prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = grid_search(prepared, grid=self.grid, folds=self.folds, seed=self.model_seed,
                                parallelism=self.parallelism, preprocess=per_fold)
            model = PipelineModel([*(ready.stages if ready else []), found.model])
            best = {f"best_{k}": v for k, v in found.best_params.items()}
            self._judge(rows, model, "holdout", best_cv_score=found.best_score, **best)
            self._write_search(found)
            if self.curves:
                self._write_curves(prepared, found, per_fold)
        finally:
            prepared.unpersist()
        inputs = list(self.table.features) if self.table else ["features"]
        example = rows.select(quoted(self.key), *[quoted(c) for c in inputs])
        return sinks.save_model(model, f"{self.folder}/{sinks.MODEL}", example=example, key=self.key)

    def evaluate(self, spark: SparkSession, df: DataFrame, model_path: str) -> DataFrame:
        """Rebuild the same held-out rows from the seed, score them with the saved model."""
        return self._judge(self._split(df), sinks.load_model(model_path), "eval")

    def _classes(self) -> int | None:
        return len(self.table.codes) if self.table else self.classes

    def _codes(self) -> Mapping[str, int]:
        if self.table:
            return self.table.codes
        return {str(i): i for i in range(self.classes or 0)}

    def _split(self, df: DataFrame) -> DataFrame:
        if self.table:
            df = with_label_code(self.table.canonical(df, (self.key,)), self.table.label, self.table.codes,
                                 out=self.label, strict=True)
        return stratified_split(df, self.key, self.label, self.test_size, self.data_seed, strict=True)

    def _judge(self, rows: DataFrame, model: PipelineModel, prefix: str, **more: object) -> DataFrame:
        held = rows.where(F.col("split") == "test")
        names = self._codes()
        scored = model.transform(held).select(
            decode_label(F.col(self.label), names).alias("actual"),
            decode_label(F.col("prediction"), names).alias("predicted"), "probability",
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = metrics.confusion_counts(scored, "actual", "predicted")
            record = metrics.metrics_record(
                counts, model_random_state=self.model_seed, test_size=self.test_size,
                data_random_state=self.data_seed, data_input=self.data_input, use_scaling=self.use_scaling, **more,
            )
            self._write(prefix, {
                sinks.METRICS: record, sinks.REPORT: metrics.classification_report(counts),
                sinks.CONFUSION: metrics.confusion_matrix(counts), **self._roc_tables(scored, names),
            })
        finally:
            scored.unpersist()
        return rows.sparkSession.read.schema(record.schema).json(f"{self.folder}/{prefix}/{sinks.METRICS}")

    def _roc_tables(self, scored: DataFrame, names: Mapping[str, int]) -> dict[str, DataFrame]:
        p = vector_to_array("probability")
        chances = {name: F.get(p, F.lit(code)) for name, code in names.items()}
        each = roc.one_vs_rest(scored, "actual", chances)
        return {"roc_points": roc.roc_points(each, ["class"]), "auc": roc.auc(each, ["class"])}

    def _write(self, prefix: str, tables: Mapping[str, DataFrame]) -> None:
        for name, table in tables.items():
            sinks.write_artifact(table, f"{self.folder}/{prefix}", name)

    def _write_search(self, found: SearchResult) -> None:
        spark = found.scores.sparkSession
        params = spark.createDataFrame([(k, json.dumps(v)) for k, v in found.best_params.items()],
                                       "parameter string, value string")
        summary = spark.createDataFrame([(found.best_score, json.dumps(found.best_params))],
                                        "best_cv_score double, best_params string")
        self._write("holdout", {sinks.BEST_PARAMS: params, sinks.SEARCH_SUMMARY: summary,
                                "candidates": found.candidates})
        sinks.write_artifact(found.results, f"{self.folder}/holdout", sinks.CV_RESULTS, format="csv")

    def _write_curves(self, prepared: DataFrame, found: SearchResult, per_fold: Pipeline | None) -> None:
        """The learning curve scales each sample by itself; the out-of-bag curve takes plain features."""
        scores = curve_ops.learning_curve_scores(prepared, found.best_params, folds=self.folds, seed=self.model_seed,
                                                 parallelism=self.parallelism, preprocess=per_fold)
        plain = prepared
        if per_fold is not None:
            plain = preprocessing_pipeline(self.table).fit(prepared).transform(prepared)
        errors = curve_ops.oob_curve(plain, self.key, found.best_params, seed=self.model_seed, parallelism=self.parallelism)
        self._write("holdout", {"learning_curve": curve_ops.learning_curve(scores), "oob_curve": errors})


def predict_sample(model_path: str, df: DataFrame, codes: Mapping[str, int], keep: Sequence[str] = ()) -> DataFrame:
    """Prediction, class name and probabilities of a few hand-made rows under a saved model."""
    scored = sinks.load_model(model_path).transform(df)
    return scored.select(
        *[quoted(c) for c in keep], F.col("prediction").cast("long").alias("prediction"),
        decode_label(F.col("prediction").cast("long"), codes).alias("predicted_label"),
        vector_to_array("probability").alias("probability"),
    )
