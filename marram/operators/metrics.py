"""Classification metrics from one count matrix.

The data is folded once to (actual, predicted, n). Every figure after that is computed from this
table of at most classes x classes rows.

Labels are compared as text, and null is a label like any other: a row with a null counts in every
figure, and only null against null is a hit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions.features import quoted


def align_predictions(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Bring label and prediction onto one row by key; order of rows plays no part."""
    return labels.join(predictions, key)


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    hit = quoted(actual).cast("string").eqNullSafe(quoted(predicted).cast("string")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Occurring (actual, predicted) pairs with their counts."""
    return df.groupBy(
        quoted(actual).cast("string").alias("actual"), quoted(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """All label pairs, zeros included; labels are the union of both sides.

    Works on the count table only. The label list is part of the result's own size.
    """
    named = counts.select("*", F.explode(F.array("actual", "predicted")).alias("name"))
    # In structs, because a set of plain values would leave null out.
    labels = named.agg(F.transform(F.sort_array(F.collect_set(F.struct("name"))), lambda s: s["name"]).alias("labels"))
    grid = labels.select(F.explode("labels").alias("actual"), "labels").select(
        "actual", F.explode("labels").alias("predicted")
    )
    same = lambda c: F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}"))
    return grid.alias("g").join(counts.alias("c"), same("actual") & same("predicted"), "left").select(
        "g.actual", "g.predicted", F.coalesce("c.n", F.lit(0)).cast("long").alias("n")
    )


def confusion_wide(counts: DataFrame, labels: Iterable[str]) -> DataFrame:
    """One row per actual label and one count column per predicted label."""
    return counts.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n")).na.fill(0)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom.cast("double"))


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label; a zero denominator gives 0."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(zero)
    as_actual = F.struct(F.col("actual").alias("label"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("guessed"))
    as_guess = F.struct(F.col("predicted").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("guessed"))
    sides = counts.select(F.inline(F.array(as_actual, as_guess)))
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "guessed")])
    return sums.select(
        "label", "tp", "support", "guessed",
        _ratio(F.col("tp"), F.col("guessed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("guessed")).alias("f1_score"),
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """Class rows, then `accuracy`, `macro avg` and `weighted avg`, told apart by `kind`."""
    def row(kind: str, label: Column, scores: tuple[Column, Column, Column], weight: Column) -> Column:
        p, r, f = scores
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"), p.alias("p"), r.alias("r"),
                        f.alias("f"), weight.alias("w"), F.col("support").alias("support"))

    own = (F.col("precision"), F.col("recall"), F.col("f1_score"))
    one, support = F.lit(1).cast("long"), F.col("support")
    # tp / support averaged with weight `support` is sum(tp) / sum(support): the accuracy.
    share = _ratio(F.col("tp"), support)
    rows = class_scores(counts).select(F.inline(F.array(
        row("class", F.col("label"), own, one),
        row("average", F.lit("accuracy"), (share, share, share), support),
        row("average", F.lit("macro avg"), own, one),
        row("average", F.lit("weighted avg"), own, support),
    )))
    mean = lambda c: _ratio(F.sum(F.col(c) * F.col("w")), F.sum("w"))
    return rows.groupBy("kind", "label").agg(
        mean("p").alias("precision"), mean("r").alias("recall"), mean("f").alias("f1_score"),
        F.sum("support").alias("support"),
    )


def report_display(report: DataFrame) -> DataFrame:
    """The report as shown: no accuracy row, two decimals, whole support."""
    shown = report.where(~((F.col("kind") == "average") & (F.col("label") == "accuracy")))
    return shown.select(
        "label",
        *[F.format_string("%.2f", F.col(c)).alias(c) for c in ("precision", "recall", "f1_score")],
        F.format_string("%d", F.col("support")).alias("support"),
    )


def weighted_metrics(counts: DataFrame) -> DataFrame:
    """One row: accuracy and the support-weighted averages."""
    mean = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return class_scores(counts).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        mean("precision").alias("precision_weighted"),
        mean("recall").alias("recall_weighted"),
        mean("f1_score").alias("f1_weighted"),
        F.sum("support").alias("n_rows"),
    )


def metrics_record(counts: DataFrame, **values: object) -> DataFrame:
    """The run's scalars in one row: metrics, chosen parameters, seeds, input description."""
    return weighted_metrics(counts).withColumns({k: F.lit(v) for k, v in values.items()})
