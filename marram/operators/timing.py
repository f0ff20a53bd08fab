"""Daily monitoring windows and trailing averages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.session import shuffle_width

# Rows of trailing windows that are sorted and summed in one task.
ROWS_PER_TASK = 500_000

DAY_START = "3 hours 15 minutes"  # fixed value: the daily monitor runs at 03:15


def daily_window(time: Column, start: str = DAY_START) -> Column:
    return F.window(time, "1 day", "1 day", start)


def daily_counts(df: DataFrame, time: str, group: Sequence[str], **sums: Column) -> DataFrame:
    """Aggregates per 24-hour window and group; folds on the map side."""
    return df.groupBy(daily_window(quoted(time)).alias("w"), *group).agg(
        F.count(F.lit(1)).alias("n"), *[e.alias(n) for n, e in sums.items()]
    ).select(F.col("w.start").alias("window_start"), *group, "n", *sums)


@dataclass(frozen=True)
class TrailingRule:
    """Act when the mean of the last `minutes` is above (or below) the threshold."""

    action: str
    minutes: int
    threshold: float
    above: bool


# The two scaling rules.
SCALING_RULES = (
    TrailingRule("out", 5, 70.0, True),
    TrailingRule("in", 10, 30.0, False),
)


def sliding_means(df: DataFrame, *, series: str, time: str, value: str, rule: TrailingRule,
                  every: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """(window_end, series, n, mean, fires) over sliding windows; works on a stream or a table.

    The streaming form of a rule: windows of the rule's length, one started `every` so often. Its
    state ends with the watermark.
    """
    timed = df
    if df.isStreaming:
        timed = df.withColumn(time, quoted(time).cast("timestamp")).withWatermark(time, lateness)
    v = quoted(value).cast("double")
    means = timed.groupBy(F.window(quoted(time), f"{rule.minutes} minutes", every).alias("w"), quoted(series).alias(series)).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"))
    mean = F.col("mean")
    fires = mean > rule.threshold if rule.above else mean < rule.threshold
    return means.select(F.col("w.end").alias("window_end"), series, "n", "mean",
                        F.coalesce(fires, F.lit(False)).alias("fires"))


def trailing_threshold(
    df: DataFrame,
    *,
    row_id: str,
    series: str,
    time: str,
    value: str,
    rules: Sequence[TrailingRule] = SCALING_RULES,
) -> DataFrame:
    """(row id, action, mean, fires) for every row and rule; the window is [t - minutes, t].

    Time is cut into blocks as long as the window, so a row's window is the end of the block
    before plus the start of its own. Both parts are running sums inside (series, rule, block):
    linear work, no series in one task, and no long sums to cancel. A sliding frame would add up
    the whole window again for every row. Blocks are dealt to as many tasks as the rows ask for.
    A row without a time has no window: its mean is null and nothing fires.
    """
    micros = F.unix_micros(quoted(time).cast("timestamp"))
    numbered = F.array(*[
        F.struct(F.lit(i).alias("rule"), F.lit(r.minutes * 60_000_000).cast("long").alias("width"))
        for i, r in enumerate(rules)
    ])
    everything = df.select(
        quoted(row_id).alias("id"), quoted(series).alias("series"), quoted(value).cast("double").alias("v"),
        micros.alias("t"), F.inline(numbered),
    )
    rows = everything.where(F.col("t").isNotNull()).withColumn("block", F.expr("(t - pmod(t, width)) div width"))
    nothing = F.lit(None).cast("double")
    # own: counts in its block; halo: shows itself to the next block; probe: where the window opens.
    record = lambda block, pos, own, halo, kind: F.struct(
        block.alias("block"), pos.alias("pos"), own.alias("own"), halo.alias("halo"), F.lit(kind).alias("kind")
    )
    t, v, block = F.col("t"), F.col("v"), F.col("block")
    cell = ["series", "rule", "block"]
    marks = rows.select("id", "series", "rule", F.inline(F.array(
        record(block, t, v, nothing, 0),
        record(block + 1, t, nothing, v, 1),
        record(block, t - F.col("width"), nothing, nothing, 2),
    )))
    # A task's memory stays as it is when the table grows.
    n_marks = 3 * len(rules) * df.count()
    marks = marks.repartition(max(shuffle_width(df.sparkSession), -(-n_marks // ROWS_PER_TASK)), *cell)
    start = Window.partitionBy(*cell).orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    end = Window.partitionBy(*cell).orderBy(F.desc("pos")).rangeBetween(Window.unboundedPreceding, 0)
    summed = marks.select(
        "id", *cell, "kind",
        F.sum("own").over(start).alias("own_sum"), F.count("own").over(start).alias("own_n"),
        F.sum("halo").over(end).alias("halo_sum"), F.count("halo").over(end).alias("halo_n"),
    ).where("kind <> 1")
    is_own, is_probe = F.col("kind") == 0, F.col("kind") == 2
    pick = lambda c, when: F.coalesce(F.max(F.when(when, F.col(c))), F.lit(0))
    # (series, rule, block, id) is finer than the shuffle key, so this grouping moves no rows.
    whole = summed.groupBy(*cell, "id").agg(
        (pick("own_sum", is_own) + pick("halo_sum", is_probe)).alias("total"),
        (pick("own_n", is_own) + pick("halo_n", is_probe)).alias("n"),
    )
    mean = F.col("mean")
    per_rule = lambda pick: F.element_at(F.array(*[F.lit(pick(r)) for r in rules]), F.col("rule") + 1)
    threshold = per_rule(lambda r: r.threshold)
    fires = F.when(per_rule(lambda r: r.above), mean > threshold).otherwise(mean < threshold)
    judged = whole.withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n"))).select("id", "rule", "mean")
    judged = judged.union(everything.where(F.col("t").isNull()).select("id", "rule", F.lit(None).cast("double")))
    return judged.select(
        F.col("id").alias(row_id), per_rule(lambda r: r.action).alias("action"), "mean",
        F.coalesce(fires, F.lit(False)).alias("fires"),
    )
