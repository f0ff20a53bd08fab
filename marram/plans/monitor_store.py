"""Monitoring from mergeable partials: a batch is read once, and a day is the merge of what its batches left.

A partial has one row per day, feature and bin with counts, sums and extremes, so its size follows from features and bins and
never from the rows. A late batch writes partials of its own days, and only those days' reports change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators.drift import HALF, js_share
from marram.plans.monitor_daily import DAY_END
from marram.session import drop_path


def monitor_day(collected_at: Column) -> Column:
    """The day on whose morning a row is looked at: the 24 hours up to 03:15 are one day."""
    minutes = DAY_END.hour * 60 + DAY_END.minute
    return F.date_add((collected_at - F.expr(f"interval {minutes} minutes")).cast("date"), 1)


@dataclass(frozen=True)
class MonitorStore:
    """Partials under `root`: `baseline` and, by day and batch, `partials`. Edges and bounds stay the same from day to day."""

    root: str
    edges: Mapping[str, Sequence[float]]
    bounds: Mapping[str, tuple[float, float]]

    def partials(self, rows: DataFrame, day: Column) -> DataFrame:
        """(monitor_day, feature, bin, n, n_outside, total, squares, low, high); a missing value has the bin after the last."""
        names = list(self.edges)
        cutter = Bucketizer(
            splitsArray=[[float("-inf"), *self.edges[f], float("inf")] for f in names],
            inputCols=[f"__v{i}" for i in range(len(names))], outputCols=[f"__b{i}" for i in range(len(names))], handleInvalid="keep")
        held = rows.select(day.alias("monitor_day"), *[quoted(f).cast("double").alias(f"__v{i}") for i, f in enumerate(names)])
        tall = cutter.transform(held).select("monitor_day", F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"),
                     F.coalesce(F.col(f"__b{i}").cast("int"), F.lit(len(self.edges[f]) + 1)).alias("bin"),
                     F.nanvl(f"__v{i}", F.lit(None)).alias("v"),
                     F.lit(float(self.bounds[f][0])).alias("least"), F.lit(float(self.bounds[f][1])).alias("most"))
            for i, f in enumerate(names)])))
        return tall.groupBy("monitor_day", "feature", "bin").agg(
            F.count(F.lit(1)).alias("n"), F.count_if((F.col("v") < F.col("least")) | (F.col("v") > F.col("most"))).alias("n_outside"),
            F.sum("v").alias("total"), F.sum(F.col("v") * F.col("v")).alias("squares"), F.min("v").alias("low"), F.max("v").alias("high"))

    def set_baseline(self, rows: DataFrame) -> None:
        self.partials(rows, F.lit(None).cast("date")).drop("monitor_day").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/baseline")

    def add(self, batch: DataFrame, batch_id: int | str, time_column: str = "collected_at") -> None:
        """Read a batch once and keep its partials. A batch that is added again replaces all that it left, on any day."""
        spark = batch.sparkSession
        self.drop(spark, batch_id)
        fresh = self.partials(batch, monitor_day(quoted(time_column))).withColumn("batch_id", F.lit(str(batch_id)))
        fresh.coalesce(1).write.mode("append").partitionBy("monitor_day", "batch_id").parquet(f"{self.root}/partials")

    def drop(self, spark: SparkSession, batch_id: int | str) -> None:
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/partials/monitor_day=*/batch_id={batch_id}")
        found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        for left in found or []:
            drop_path(spark, left.getPath().toString())

    def read(self, spark: SparkSession, first: date | None = None, last: date | None = None) -> DataFrame:
        """The partials of some days; other days' folders are not opened."""
        rows = spark.read.parquet(f"{self.root}/partials")
        if first is not None:
            rows = rows.where(F.col("monitor_day") >= F.lit(first))
        return rows if last is None else rows.where(F.col("monitor_day") <= F.lit(last))

    def report(self, spark: SparkSession, first: date | None = None, last: date | None = None) -> DataFrame:
        """One row per day and feature: counts, moments, extremes, and the distance of its bins from the baseline's.

        Bins that neither side has still count, each with half a row added. Days without a row of a feature have none.
        """
        sums = [F.sum(c).alias(c) for c in ("n", "n_outside", "total", "squares")]
        ends = [F.min("low").alias("low"), F.max("high").alias("high")]
        merged = self.read(spark, first, last).groupBy("monitor_day", "feature", "bin").agg(*sums, *ends)
        sizes = spark.createDataFrame([(f, len(e) + 1) for f, e in self.edges.items()], "feature string, bins int")
        bins_of = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
        old = spark.read.parquet(f"{self.root}/baseline").groupBy("feature").agg(bins_of.alias("before"))
        # Both tables have one row per feature that the store was made for.
        known = F.broadcast(sizes.join(old, "feature", "left"))
        valid = F.col("bin") < F.col("bins")
        daily = merged.join(known, "feature").groupBy("monitor_day", "feature", "bins", "before").agg(
            F.sum("n").alias("n_rows"), F.sum(F.when(~valid, F.col("n")).otherwise(0)).alias("n_missing"),
            F.sum("n_outside").alias("n_outside"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
            F.min("low").alias("low"), F.max("high").alias("high"), bins_of.alias("now"))
        every = F.sequence(F.lit(0), F.col("bins") - 1)

        def shares(side: str) -> Column:
            counts = F.transform(every, lambda b: F.coalesce(F.try_element_at(F.col(side), b), F.lit(0)))
            total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)
            return F.transform(counts, lambda n: (n + HALF) / (total + HALF * F.col("bins")))

        counted = daily.withColumns({"before_p": shares("before"), "now_p": shares("now")})
        measure = lambda each: F.aggregate(F.zip_with("before_p", "now_p", each), F.lit(0.0), lambda a, x: a + x)
        n = F.col("n_rows") - F.col("n_missing")
        mean = F.try_divide("total", n)
        return counted.select(
            "monitor_day", "feature", "n_rows", "n_missing", "n_outside", mean.alias("mean"),
            F.sqrt(F.greatest(F.lit(0.0), F.try_divide("squares", n) - mean * mean)).alias("std"), "low", "high",
            measure(lambda p, q: (q - p) * F.ln(q / p)).alias("psi"), F.sqrt(measure(js_share)).alias("js_distance"))
