"""Baseline profiles, data quality and exact quantiles, many features in one pass."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators.ranking import range_edges_of, rows_at_rank, with_range_bucket


def unpivot_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep…, feature, value), one row per input row and feature; folds again on the map side."""
    values = F.array(*[
        F.struct(F.lit(f).alias("feature"), quoted(f).alias("value")) for f in features
    ])
    return df.select(*[quoted(k) for k in keep], F.inline(values))


def numeric_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, population std, min and max per feature: one wide aggregate, one pass."""
    aggs = []
    for i, f in enumerate(features):
        v = quoted(f).cast("double")
        aggs.append(F.struct(
            F.lit(f).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("mean"),
            F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        ).alias(f"f{i}"))
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[F.col(f"f{i}") for i in range(len(features))])))


def exact_quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float],
                    buckets: int | None = None) -> DataFrame:
    """(feature, prob, value): the smallest value with at least prob * n rows at or below it.

    Value ranges are counted for all features in one pass, and only the ranges that hold a wanted
    rank are read again. Columns are never sorted.
    """
    spark = df.sparkSession
    values = {f: quoted(f).cast("double") for f in features}
    sizes = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())]).first()
    wanted = [(f, p, _ceil_rank(p, sizes[i])) for i, f in enumerate(features) for p in probs if sizes[i]]
    if not wanted:
        return spark.createDataFrame([], "feature string, prob double, value double")
    edges = range_edges_of(df, values, buckets)
    placed = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    for i, f in enumerate(features):
        placed = with_range_bucket(placed, F.col(f"v{i}"), edges[f], f"b{i}")
    tall = placed.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"b{i}").alias("range"), F.col(f"v{i}").alias("value"))
        for i, f in enumerate(features)
    ]))).where(F.col("value").isNotNull())
    targets = spark.createDataFrame(wanted, "feature string, target double, want long")
    found = rows_at_rank(tall, targets, group=["feature"], bucket="range", order=["value"])
    return found.select("feature", F.col("target").alias("prob"), "value")


def _ceil_rank(prob: float, total: int) -> int:
    return max(1, math.ceil(prob * total))


def feature_profile(df: DataFrame, features: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75),
                    *, exact: bool = True) -> DataFrame:
    """`numeric_profile` plus one `q<percent>` column per probability."""
    base = numeric_profile(df, features)
    names = {p: f"q{round(p * 100)}" for p in probs}
    if not exact:
        stacked = unpivot_features(df, features)
        marks = stacked.groupBy("feature").agg(
            *[F.percentile_approx(F.col("value").cast("double"), p, 10_000).alias(n) for p, n in names.items()]
        )
        return base.join(marks, "feature", "left")
    wide = exact_quantiles(df, features, probs).groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()]
    )
    return base.join(wide, "feature", "left")


def value_bounds(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Baseline (min, max) per feature as plain numbers, for use as constants later."""
    rows = numeric_profile(df, features).select("feature", "min", "max").collect()
    return {r.feature: (r["min"], r["max"]) for r in rows}


def data_quality(df: DataFrame, features: Sequence[str], bounds: Mapping[str, tuple[float, float]],
                 group: Sequence[str] = ()) -> DataFrame:
    """Null, type-error and out-of-bounds counts and rates per (group…, feature).

    A value counts as a type error when it is present and no number; bounds are inclusive.
    """
    rows = df.select(*[quoted(g) for g in group], F.inline(F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            quoted(f).isNull().cast("int").alias("is_null"),
            (quoted(f).isNotNull() & quoted(f).try_cast("double").isNull()).cast("int").alias("bad_type"),
            F.coalesce(~quoted(f).try_cast("double").between(*bounds[f]), F.lit(False)).cast("int").alias("outside"),
        ) for f in features
    ])))
    counted = rows.groupBy(*group, "feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_null").alias("nulls"),
        F.sum("bad_type").alias("type_errors"), F.sum("outside").alias("out_of_bounds"),
    )
    return counted.withColumns({
        "null_rate": F.col("nulls") / F.col("n"),
        "type_error_rate": F.col("type_errors") / F.col("n"),
        "out_of_bounds_rate": F.col("out_of_bounds") / F.col("n"),
    })
