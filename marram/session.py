"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

# Rows of a narrow table for one task.
ROWS_PER_TASK = 1 << 16
# Tasks get several buckets each, so one heavy bucket never decides a stage's length.
BUCKETS_PER_TASK = 16


def build_session(app_name: str = "marram", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_target(spark: SparkSession) -> int:
    """How many pieces a global order or a hot group is cut into; scales with the cluster."""
    return max(64, min(BUCKETS_PER_TASK * shuffle_width(spark), 50_000))


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """A narrow table of about so many rows, in no more tasks than they ask for, and at least as many as there are cores.

    Every task leaves files of its own in a shuffle and a checkpoint, so a small table that passes through many of them in a
    wide shuffle takes more disk for files than for rows. A table that fills a shuffle stays as it is.
    """
    tasks = max(cores(df.sparkSession), -(-rows // ROWS_PER_TASK))
    return df.coalesce(tasks) if tasks < shuffle_width(df.sparkSession) else df


def count_written(df: DataFrame) -> int:
    """Rows of a checkpoint, counted by one task per core."""
    return df.coalesce(cores(df.sparkSession)).count()


def kept(df: DataFrame) -> DataFrame:
    """A narrow table, checkpointed, and read by no more tasks than its rows ask for."""
    written = df.checkpoint()
    return in_few_tasks(written, count_written(written))


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or where that is unset one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str, *parts: object) -> str:
    """A path that is stable within one application, so reruns overwrite instead of piling up."""
    tag = hashlib.md5(repr(parts).encode()).hexdigest()[:10]
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{tag}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this application wrote, on whatever file system it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable; a directory set by the cluster is kept."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
