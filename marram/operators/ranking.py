"""Global orders without a global task.

A plain window over a whole table, or over a class that holds a third of it, runs in one task.
Here the order is cut into buckets that follow it (hash prefixes, or ranges of a number). Per-bucket
totals form a small table; its running sums carry each bucket's start, and only rows of one bucket
are ever sorted together. Results are exact and do not depend on the number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marram.functions.features import quoted
from marram.session import bucket_target

EDGE_SAMPLE_ROWS = 500_000  # numbers fetched per column, whatever the table's size
SMALL_ROWS = 10_000


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a side only once its row count is known to be within the limit.

    Within the limit the rows are fetched and become a literal table, which also stops the plan
    that made them from running again. Beyond it the side is returned as it was and Spark joins
    it by shuffle.
    """
    held = df.limit(limit + 1).toArrow()
    if held.num_rows > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(held, df.schema))


def range_edges(df: DataFrame, order: Column, buckets: int | None = None) -> list[float]:
    """Inner edges that cut a numeric order into roughly equal buckets."""
    return range_edges_of(df, {"v": order}, buckets)["v"]


def range_edges_of(df: DataFrame, orders: Mapping[str, Column], buckets: int | None = None) -> dict[str, list[float]]:
    """Edges for several orders at once.

    Edges come from a row sample of bounded size. They set only how evenly the work is spread;
    every row still takes part and every result is the same for any edges.
    """
    buckets = buckets or bucket_target(df.sparkSession)
    values = df.select(*[c.cast("double").alias(f"v{i}") for i, c in enumerate(orders.values())])
    share = min(1.0, EDGE_SAMPLE_ROWS / max(values.count(), 1))
    if share < 1.0:
        values = values.sample(withReplacement=False, fraction=share, seed=17)
    held = values.toArrow()
    return {name: _even_edges(held.column(i).to_numpy(), buckets) for i, name in enumerate(orders)}


def _even_edges(sample: np.ndarray, buckets: int) -> list[float]:
    """Half of the edges are quantiles of the rows and half of the distinct values.

    Some users sort rows and some sort folded values. With both kinds of edges no bucket holds more
    than twice its share of either, however the values tie (a value's own rows stay together).
    """
    known = np.sort(sample[np.isfinite(sample)])
    if known.size == 0:
        return []
    half = max(1, -(-buckets // 2))
    edges = [v[np.arange(1, half + 1) * v.size // (half + 1)] for v in (known, np.unique(known))]
    return np.unique(np.concatenate(edges)).tolist()


def with_range_bucket(df: DataFrame, order: Column, edges: Sequence[float], out: str) -> DataFrame:
    """Number of the range a value falls in; the search in the edges runs on the JVM."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    held = f"{out}__value"
    cutter = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol=held, outputCol=out, handleInvalid="keep"
    )
    cut = cutter.transform(df.withColumn(held, order.cast("double")))
    return cut.withColumn(out, F.col(out).cast("int")).drop(held)


def order_text(df: DataFrame, names: Sequence[str]) -> Column:
    """A text that sorts, byte by byte, as rows sort by these columns: text, whole numbers, dates and times; nulls first."""
    parts = []
    for name in names:
        kind, col = df.schema[name].dataType, quoted(name)
        if isinstance(kind, T.StringType):
            told = F.hex(col)
        elif isinstance(kind, T.IntegralType):
            told = F.lpad(F.hex(col.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            told = F.date_format(col, "yyyyMMddHHmmssSSSSSS")
        else:
            raise TypeError(f"{name}: {kind.simpleString()} has no order as text here")
        # The sign that ends a part is less than any digit, and that of a value more than that of a null.
        parts.append(F.coalesce(F.concat(F.lit("#"), told, F.lit("!")), F.lit("!")))
    return F.concat(*parts)


def with_text_bucket(df: DataFrame, order: Column, out: str, buckets: int | None = None) -> DataFrame:
    """Number of the range a text falls in; edges come from a sample of bounded size and never decide a result."""
    buckets = buckets or bucket_target(df.sparkSession)
    placed = df.withColumn(f"{out}__text", order)
    rows = min(EDGE_SAMPLE_ROWS, 64 * buckets)
    share = min(1.0, rows / max(placed.count(), 1))
    sample = placed.select(f"{out}__text")
    held = (sample if share == 1.0 else sample.sample(withReplacement=False, fraction=share, seed=17)).toArrow()
    known = np.sort(held.column(0).to_numpy(zero_copy_only=False).astype(object))
    edges = np.unique(known[np.arange(1, buckets) * known.size // buckets]) if known.size else known

    @F.pandas_udf("int")
    def bucket(texts: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, texts.to_numpy(dtype=object), side="right"))

    return placed.withColumn(out, bucket(f"{out}__text")).drop(f"{out}__text")


def running_totals(
    df: DataFrame,
    sums: Mapping[str, Column],
    *,
    group: Sequence[str] = (),
    bucket: Sequence[str],
    order: Sequence[Column],
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Inclusive running sum of each expression along (bucket, order) within the group.

    `bucket` must follow the wanted order. Group totals of the sums arrive as `<name>__total`.
    Each `extra` aggregate is taken per bucket, and a row gets the next bucket's value as
    `<name>__next`: what a `lead` needs at the end of its own bucket.

    The bucket key is one struct, so the window and the join with bucket starts share a single
    shuffle of the large side, and NULL groups keep their rows.
    """
    extra = dict(extra or {})
    cell = "__cell"
    held = {f"__v_{n}": e for n, e in sums.items()}
    rows = df.withColumns(held).withColumn(
        cell, F.struct(F.struct(*[quoted(g) for g in group], F.lit(0).alias("_g")).alias("g"),
                       F.struct(*[quoted(b) for b in bucket]).alias("b"))
    )
    cells = rows.groupBy(cell).agg(
        *[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in sums],
        *[e.alias(f"__x_{n}") for n, e in extra.items()],
    )
    along = Window.partitionBy(f"{cell}.g").orderBy(f"{cell}.b")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(f"{cell}.g")
    starts = cells.select(
        cell,
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__s_{n}").over(whole).alias(f"{n}__total") for n in sums],
        *[F.lead(f"__x_{n}").over(along).alias(f"{n}__next") for n in extra],
    )
    inside = Window.partitionBy(cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({n: F.sum(f"__v_{n}").over(inside) for n in sums})
    joined = summed.join(starts, cell)
    return joined.withColumns({n: F.col(n) + F.col(f"__o_{n}") for n in sums}).drop(
        *held, *[f"__o_{n}" for n in sums]
    )


def bucket_window(order: Sequence[Column]):
    """Order inside one bucket, for use on the output of `running_totals`."""
    return Window.partitionBy("__cell").orderBy(*order)


def global_rank(
    df: DataFrame, *, group: Sequence[str] = (), bucket: Sequence[str], order: Sequence[Column],
    out: str = "rank",
) -> DataFrame:
    """1-based row number along (bucket, order) within the group."""
    ranked = running_totals(df, {out: F.lit(1)}, group=group, bucket=bucket, order=order)
    return ranked.drop("__cell", f"{out}__total")


def rows_at_rank(
    df: DataFrame,
    targets: DataFrame | Mapping[str, int],
    *,
    group: Sequence[str] = (),
    bucket: str,
    order: Sequence[str],
    cells: DataFrame | None = None,
    widen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The order values found at wanted ranks, without sorting the table.

    `targets` holds (group…, `target`, `want`), or is a plain mapping target -> want when there is
    no group. Bucket counts tell which bucket holds each wanted rank; only the rows of those
    buckets are read again, folded to distinct order values with their counts, and ranked.
    Returns (group…, target, order…).

    For overlapping groups, `cells` gives the counts (group…, bucket, n) and `widen` spreads rows
    over their groups; it is applied to the rows of the needed buckets only.
    """
    names = list(group)
    if cells is None:
        cells = df.groupBy(*names, bucket).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*names).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    spans = cells.withColumn("upto", F.sum("n").over(upto))
    start = F.col("upto") - F.col("n")
    if isinstance(targets, Mapping):
        wanted = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(w).cast("long").alias("want"))
                           for t, w in targets.items()])
        inside_cell = F.filter(wanted, lambda w: (w["want"] <= F.col("upto")) & (w["want"] > start))
        hit = spans.select("*", F.inline(inside_cell))
    else:
        hit = spans.join(targets, names).where((F.col("want") <= F.col("upto")) & (F.col("want") > start))
    hit = small_side(hit.select(*names, bucket, "target", (F.col("want") - start).alias("left")))
    cell = [*names, bucket]

    near = df
    if widen is not None:
        near = widen(df.join(small_side(hit.select(bucket).distinct()), bucket, "left_semi"))
    near = near.join(small_side(hit.select(*cell).distinct()), cell, "left_semi")
    folded = near.groupBy(*cell, *order).agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = folded.withColumn("upto", F.sum("n").over(inside))
    found = ranked.join(hit, cell).where((F.col("left") <= F.col("upto")) & (F.col("left") > start))
    return found.select(*names, "target", *order)
