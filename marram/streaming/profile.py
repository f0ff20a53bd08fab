"""Daily profile of an event stream: late rows dropped, repeated events counted once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marram.functions.features import quoted
from marram.operators.timing import daily_window


def daily_profile(events: DataFrame, *, time: str, event_id: str, group: Sequence[str], value: str,
                  lateness: str = "1 day") -> DataFrame:
    """(window_start, group…, n, total, low, high) per monitoring day; works on a stream or a table.

    All state has an end: event ids and windows are let go once the watermark passes them.
    """
    timed = events.withColumn(time, quoted(time).cast("timestamp")).withWatermark(time, lateness)
    if events.isStreaming:
        timed = timed.dropDuplicatesWithinWatermark([event_id])
    else:
        timed = timed.dropDuplicates([event_id])
    v = quoted(value).cast("double")
    return timed.groupBy(daily_window(quoted(time)).alias("w"), *group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high")
    ).select(F.col("w.start").alias("window_start"), *group, "n", "total", "low", "high")


def stream_daily_profile(profile: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Write changed windows of every batch; a batch that runs again replaces its own folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return (
        profile.writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_daily_profile(spark: SparkSession, root: str, group: Sequence[str]) -> DataFrame:
    """The newest state of every window: later batches supersede earlier ones."""
    updates = spark.read.parquet(root)
    state = F.struct("batch_id", "n", "total", "low", "high")
    return updates.groupBy("window_start", *group).agg(F.max(state).alias("s")).select(
        "window_start", *group, "s.n", "s.total", "s.low", "s.high"
    )
