"""Prepare a feature source: resolve, build, write, register the next version."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.operators.catalogs import next_version
from marram.operators.entities import build_feature_source
from marram.schema import FeatureSetSpec, MeasuredTable
from marram.sources.readers import Candidate, resolve_source
from marram.sources.sinks import registry_records, write_feature_source


def prepare_feature_source(
    spark: SparkSession,
    candidates: Sequence[Candidate],
    table: MeasuredTable,
    order_key: str,
    root: str,
    *,
    name: str = "feature_source",
    id_column: str = "flower_id",
    strict: bool = True,
    format: str = "parquet",
) -> FeatureSetSpec:
    """Write the next version of a feature source and its registry rows; return its spec.

    Of runs at the same time each claims a version of its own.
    """
    source = resolve_source(spark, candidates, strict=strict)
    built = build_feature_source(table.canonical(source, (order_key,)), table, order_key, id_column=id_column)
    version = claim_version(spark, root, name, _next(spark, root, name))
    path = f"{root}/{name}/version={version}"
    write_feature_source(built, path, format=format)
    spec = FeatureSetSpec.of(built, name, (id_column,), version=version, path=path)
    written = spark.read.schema(built.schema).format(format).option("header", True).load(path)
    records = registry_records(written, spec).withColumns({
        "path": F.lit(path), "registered_at": F.lit(datetime.now().isoformat(timespec="seconds")),
    })
    # One folder per (name, version): registering a version again replaces its rows.
    records.write.mode("overwrite").parquet(f"{root}/registry/asset={name}/asset_version={version}")
    return spec


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", False).parquet(f"{root}/registry")


def registered_spec(spark: SparkSession, root: str, name: str, version: str) -> FeatureSetSpec:
    """The spec of a registered version, built from its registry rows alone; a feature set is a few rows."""
    known = read_registry(spark, root).where((F.col("asset") == name) & (F.col("version") == version))
    rows = known.orderBy("position").collect()
    if not rows:
        raise LookupError(f"{name} has no registered version {version}")
    first = rows[0]
    return FeatureSetSpec(
        name=first.feature_set, index=tuple(first.index_columns.split(",")), features={r.feature: r.type for r in rows},
        timestamp=first.timestamp_column, timestamp_format=first.timestamp_format, version=first.version, entity=first.entity,
        entity_version=first.entity_version, path=first.path)


def claim_version(spark: SparkSession, root: str, name: str, first: str) -> str:
    """The first free version from `first` on. A claim is a file that is made only where there is none, so two runs never share one."""
    version = int(first)
    while not _made(spark, f"{root}/claims/{name}/{version}"):
        version += 1
    return str(version)


def _made(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one. A store decides that by itself, a mounted folder by its file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getScheme() == "file":
        files.mkdirs(place.getParent())
        return jvm.java.io.File(files.makeQualified(place).toUri().getPath()).createNewFile()
    try:
        files.create(place, False).close()
        return True
    except Py4JJavaError:
        if not files.exists(place):
            raise  # not taken, but not to be written either
        return False


def _next(spark: SparkSession, root: str, name: str) -> str:
    try:
        known = resolve_source(spark, [Candidate("registry", f"{root}/registry")])
    except FileNotFoundError:
        return "1"
    row = next_version(known.where(F.col("asset") == name), "asset", "version").first()
    return row.next_version if row else "1"
