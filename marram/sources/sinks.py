"""Written tables. Every write replaces exactly what it names, so a rerun leaves no double rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators.catalogs import first_by_key
from marram.schema import FeatureSetSpec

# Names under which a run's results are kept.
METRICS = "metrics"
BEST_PARAMS = "best_params"
SEARCH_SUMMARY = "grid_search_summary"
CV_RESULTS = "cv_results"
REPORT = "classification_report"
CONFUSION = "confusion_matrix"
MODEL = "model"


def write_feature_source(df: DataFrame, path: str, *, format: str = "parquet",
                         time_column: str = "event_timestamp", partition_by_date: bool = False) -> None:
    """Feature table in its given column order; optionally one folder per event date."""
    writer = df
    if partition_by_date:
        writer = df.withColumn("event_date", F.substring(quoted(time_column).cast("string"), 1, 10))
    out = writer.write.mode("overwrite").format(format)
    if format == "csv":
        out = out.option("header", True)
    if partition_by_date:
        out = out.partitionBy("event_date")
    out.save(path)


def run_path(root: str, run_id: str, started: datetime | None = None) -> str:
    """`root/date/time_run`: one folder per run, sorted by start."""
    started = started or datetime.now()
    return f"{root.rstrip('/')}/{started:%Y-%m-%d}/{started:%H%M%S}_{run_id}"


def write_artifact(df: DataFrame, run_folder: str, name: str, *, format: str = "json") -> str:
    """One small result table under its shared name in the run's folder."""
    path = f"{run_folder}/{name}"
    out = df.write.mode("overwrite").format(format)
    if format == "csv":
        out = out.option("header", True)
    out.save(path)
    return path


def save_model(model: PipelineModel, path: str, example: DataFrame | None = None, key: str | None = None) -> str:
    """The fitted pipeline, with its input schema and one example row beside it."""
    model.write().overwrite().save(f"{path}/pipeline")
    if example is not None and key is not None:
        spark = example.sparkSession
        first_by_key(example, key).write.mode("overwrite").parquet(f"{path}/input_example")
        signature = spark.createDataFrame([(example.schema.json(),)], "schema_json string")
        signature.write.mode("overwrite").json(f"{path}/signature")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def write_collection(inputs: DataFrame, outputs: DataFrame, root: str, batch_id: int | str) -> None:
    """Both collected tables for one batch; the batch's folder is replaced as a whole."""
    inputs.write.mode("overwrite").parquet(f"{root}/model_inputs/batch_id={batch_id}")
    outputs.write.mode("overwrite").parquet(f"{root}/model_outputs/batch_id={batch_id}")


def read_collection(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.parquet(f"{root}/model_inputs").drop("batch_id"),
            spark.read.parquet(f"{root}/model_outputs").drop("batch_id"))


def registry_records(df: DataFrame, spec: FeatureSetSpec) -> DataFrame:
    """One row per feature of a built feature table: its contract and what the table holds.

    Contract parts come from the schema; row and value counts and the time span from one aggregate.
    """
    names = list(spec.features)
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(quoted(spec.timestamp)).alias("first_event"),
        F.max(quoted(spec.timestamp)).alias("last_event"),
        *[F.count(quoted(f)).alias(f"__n_{i}") for i, f in enumerate(names)],
    )
    each = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f).alias("feature"), F.lit(spec.features[f]).alias("type"),
                 F.col(f"__n_{i}").alias("n_values")) for i, f in enumerate(names)
    ])
    return wide.select(
        F.lit(spec.name).alias("feature_set"), F.lit(spec.version).alias("version"),
        F.lit(spec.entity).alias("entity"), F.lit(spec.entity_version).alias("entity_version"),
        F.lit(",".join(spec.index)).alias("index_columns"), F.lit(spec.timestamp).alias("timestamp_column"),
        F.lit(spec.timestamp_format).alias("timestamp_format"),
        "n_rows", "first_event", "last_event", F.inline(each),
    )
