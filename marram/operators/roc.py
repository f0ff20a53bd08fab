"""Exact one-vs-rest ROC points and areas.

Rows fold to distinct (class, score) first, on the map side; ordering is then by score range, so
neither a class nor the whole score list is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators.ranking import bucket_window, range_edges, running_totals, with_range_bucket


def one_vs_rest(df: DataFrame, label: str, scores: Mapping[str, Column]) -> DataFrame:
    """(class, positive, score): each row once per class, with that class's own score."""
    per_class = F.array(*[
        F.struct(F.lit(name).alias("class"),
                 (quoted(label).cast("string") == name).cast("int").alias("positive"),
                 score.cast("double").alias("score"))
        for name, score in scores.items()
    ])
    return df.select(F.inline(per_class))


def _score_steps(df: DataFrame, group: Sequence[str], descending: bool, buckets: int | None) -> DataFrame:
    """Distinct scores with cumulative counts along the order, totals, and the next step's counts."""
    scored = df.where(F.col("score").isNotNull() & F.col("positive").isNotNull())
    edges = range_edges(scored, F.col("score"), buckets)
    folded = scored.groupBy(*group, "score").agg(
        F.sum(F.col("positive").cast("long")).alias("p"),
        F.sum((1 - F.col("positive")).cast("long")).alias("q"),
    )
    placed = with_range_bucket(folded, F.col("score"), edges, "__range")
    step = F.struct("p", "q")
    if descending:
        placed = placed.withColumn("__range", -F.col("__range"))
        order, first = [F.desc("score")], F.max_by(step, "score")
    else:
        order, first = [F.asc("score")], F.min_by(step, "score")
    along = running_totals(placed, {"tp": F.col("p"), "fp": F.col("q")}, group=group,
                           bucket=["__range"], order=order, extra={"step": first})
    return along.withColumn(
        "next", F.coalesce(F.lead(step).over(bucket_window(order)), F.col("step__next"))
    )


def roc_points(df: DataFrame, group: Sequence[str] = (), *, drop_collinear: bool = True,
               buckets: int | None = None) -> DataFrame:
    """(group…, threshold, fpr, tpr) from (group…, positive, score), thresholds descending.

    Tied scores are one point. A point between two equal steps lies on their line and is dropped;
    the first and last points stay. The origin (threshold infinity) is added in front. Rates are
    NULL for a class without positives or without negatives.
    """
    steps = _score_steps(df, group, descending=True, buckets=buckets)
    is_first = (F.col("tp") == F.col("p")) & (F.col("fp") == F.col("q"))
    if drop_collinear:
        steps = steps.where(is_first | F.col("next").isNull() | (F.col("next") != F.struct("p", "q")))
    rate = lambda n, total: F.when(F.col(total) > 0, n / F.col(total))
    point = F.struct(
        F.col("score").alias("threshold"),
        rate(F.col("fp").cast("double"), "fp__total").alias("fpr"),
        rate(F.col("tp").cast("double"), "tp__total").alias("tpr"),
    )
    origin = F.struct(
        F.lit(float("inf")).alias("threshold"),
        rate(F.lit(0.0), "fp__total").alias("fpr"),
        rate(F.lit(0.0), "tp__total").alias("tpr"),
    )
    shown = F.when(is_first, F.array(origin, point)).otherwise(F.array(point))
    return steps.select(*group, F.inline(shown))


def auc(df: DataFrame, group: Sequence[str] = (), *, buckets: int | None = None) -> DataFrame:
    """Area under the curve per group: chance that a positive outscores a negative, ties half.

    Equal to the trapezoid area over all points. NULL without positives or without negatives.
    """
    steps = _score_steps(df, group, descending=False, buckets=buckets)
    # fp counts negatives up to and including this score: those below, plus ties.
    won = F.col("p").cast("double") * ((F.col("fp") - F.col("q")).cast("double") + 0.5 * F.col("q"))
    area = F.sum(won) / (F.max("tp__total").cast("double") * F.max("fp__total"))
    both = (F.max("tp__total") > 0) & (F.max("fp__total") > 0)
    return steps.groupBy(*group).agg(
        F.when(both, area).alias("auc"),
        F.max("tp__total").alias("positives"), F.max("fp__total").alias("negatives"),
    )
