"""The corpus pipeline: documents in, cleaned, deduplicated, decontaminated, mixed and sharded documents out.

Every stage is written as Parquet and read again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from marram.llm.cleaning import clean_documents
from marram.llm.decontaminate import without_benchmark
from marram.llm.mixing import mixed_documents
from marram.llm.near import without_near_copies
from marram.llm.sharding import sharded_documents
from marram.session import shared_root


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharded_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# XXH64 fingerprints and greedy packing are beyond SQL; tests hold run() against a plain Python version.
ORACLE_SQL = None


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Whole texts go to the stages' tasks in batches of fewer rows, so that long texts take less memory at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`. Stages are kept in a folder of this run under the shared folder."""
    root = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark):
        for k, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
            docs = spark.read.parquet(f"{root}/{k}")
    return docs
