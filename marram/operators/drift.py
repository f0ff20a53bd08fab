"""Distances between a baseline and a production sample of the same features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators.ranking import bucket_window, range_edges, running_totals, with_range_bucket

HALF = 0.5  # added to every bin so an empty bin has a finite logarithm


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x * F.ln(y))


def js_share(pb: Column, pc: Column) -> Column:
    """One bin's share of the Jensen–Shannon divergence."""
    mid = pb + pc
    return 0.5 * (_xlogy(pb, 2 * pb / mid) + _xlogy(pc, 2 * pc / mid))


def binned_drift(df: DataFrame, current: Column, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Population stability index and Jensen–Shannon distance per feature.

    `edges` are inner edges; bins are [edge, next edge) with open ends. All bins of the list take
    part, seen or not, each with half a row added. One aggregation for all features; its result
    has (features x bins) rows.
    """
    names = list(edges)
    held = {f: f"__b{i}" for i, f in enumerate(names)}
    cutter = Bucketizer(
        splitsArray=[[float("-inf"), *edges[f], float("inf")] for f in names],
        inputCols=[f"__v{i}" for i in range(len(names))], outputCols=list(held.values()),
        handleInvalid="keep",
    )
    flagged = df.select(current.cast("boolean").alias("__cur"), *[
        quoted(f).cast("double").alias(f"__v{i}") for i, f in enumerate(names)
    ])
    cut = cutter.transform(flagged)
    tall = cut.select("__cur", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(b).cast("int").alias("bin"),
                 F.lit(len(edges[f]) + 1).alias("bins")) for f, b in held.items()
    ]))).where(F.col("bin") < F.col("bins"))
    # A feature without any value still has a row, with null measures.
    listed = df.sparkSession.createDataFrame([(f,) for f in names], "feature string")
    counts = tall.groupBy("feature", "bins", "bin").agg(
        F.count_if(~F.col("__cur")).alias("nb"), F.count_if(F.col("__cur")).alias("nc")
    )
    # The count table is small: per feature, collect its bins and lay them on the full bin list.
    per = counts.groupBy("feature", "bins").agg(
        F.sum("nb").alias("tb"), F.sum("nc").alias("tc"),
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("nb", "nc")))).alias("seen"),
    )
    full = per.select("feature", "bins", "tb", "tc", "seen",
                      F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    hit = F.col("seen")[F.col("bin")]
    share = lambda n, total: (F.coalesce(n, F.lit(0)) + HALF) / (F.col(total) + HALF * F.col("bins"))
    smooth = full.select("feature", share(hit["nb"], "tb").alias("pb"), share(hit["nc"], "tc").alias("pc"))
    pb, pc = F.col("pb"), F.col("pc")
    measured = smooth.groupBy("feature").agg(
        F.sum((pc - pb) * F.ln(pc / pb)).alias("psi"), F.sqrt(F.sum(js_share(pb, pc))).alias("js_distance")
    )
    return listed.join(measured, "feature", "left")


def categorical_drift(df: DataFrame, column: str, current: Column) -> DataFrame:
    """Total variation and Jensen–Shannon distance between label shares, in one row.

    Null is a label of its own. Without rows on both sides there is nothing to compare: the measures are null.
    """
    sides = df.select(quoted(column).cast("string").alias("label"), current.alias("cur"))
    totals = sides.agg(F.count_if(~F.col("cur")).alias("b"), F.count_if(F.col("cur")).alias("c")).first()
    shares = sides.groupBy("label").agg(
        F.try_divide(F.count_if(~F.col("cur")), F.lit(totals.b)).alias("pb"),
        F.try_divide(F.count_if(F.col("cur")), F.lit(totals.c)).alias("pc"),
    )
    pb, pc = F.col("pb"), F.col("pc")
    return shares.agg(
        F.lit(column).alias("feature"), F.count(F.lit(1)).alias("labels"),
        (0.5 * F.sum(F.abs(pb - pc))).alias("total_variation"),
        F.sqrt(F.sum(F.when(pb.isNotNull() & pc.isNotNull(), js_share(pb, pc)))).alias("js_distance"),
    ).select("feature", "labels", "total_variation", "js_distance")


def exact_drift(df: DataFrame, feature: str, current: Column, buckets: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic and Wasserstein-1 distance, in one row.

    Rows fold to distinct values with two counts; the two running shares are then compared along
    value ranges. A gap to the next value may cross a range, so each range hands its first value on.
    Nulls and NaN are left out; without values on both sides the measures are null.
    """
    rows = df.select(quoted(feature).cast("double").alias("v"), current.cast("int").alias("cur")).where(
        F.col("v").isNotNull() & ~F.isnan("v") & F.col("cur").isNotNull()
    )
    edges = range_edges(rows, F.col("v"), buckets)
    folded = rows.groupBy("v").agg(F.sum((1 - F.col("cur")).cast("long")).alias("nb"),
                                   F.sum(F.col("cur").cast("long")).alias("nc"))
    placed = with_range_bucket(folded, F.col("v"), edges, "__range")
    order = [F.asc("v")]
    along = running_totals(placed, {"fb": F.col("nb"), "fc": F.col("nc")}, bucket=["__range"],
                           order=order, extra={"first": F.min("v")})
    ahead = F.coalesce(F.lead("v").over(bucket_window(order)), F.col("first__next"))
    gap = F.abs(F.try_divide("fb", "fb__total") - F.try_divide("fc", "fc__total"))
    return along.select(gap.alias("gap"), (ahead - F.col("v")).alias("width")).agg(
        F.lit(feature).alias("feature"), F.max("gap").alias("ks"),
        F.sum(F.col("gap") * F.col("width")).alias("wasserstein_1"),
    ).select("feature", "ks", "wasserstein_1")
