"""Entity keys, event times, and lookups of features by key and time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marram.functions.features import quoted, require_columns
from marram.operators.ranking import (
    global_rank, order_text, range_edges, small_side, with_range_bucket, with_text_bucket,
)
from marram.schema import MeasuredTable
from marram.session import bucket_target

# Key text, first event time and its step.
KEY_FORMAT = "flower_%05d"
FIRST_EVENT = datetime(2024, 1, 1)
EVENT_STEP = timedelta(hours=1)


def with_entity_ids(
    df: DataFrame,
    order_key: str | Sequence[str],
    *,
    id_column: str = "flower_id",
    time_column: str = "event_timestamp",
    key_format: str = KEY_FORMAT,
    first_event: datetime = FIRST_EVENT,
    step: timedelta = EVENT_STEP,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows along a unique key; give each a text id and a stepped event time.

    The key is a number, a text, a date, a time, or several such columns in their order.
    """
    names = [order_key] if isinstance(order_key, str) else list(order_key)
    if len(names) == 1 and isinstance(df.schema[names[0]].dataType, NumericType):
        placed = with_range_bucket(df, quoted(names[0]), range_edges(df, quoted(names[0]), buckets), "__range")
    else:
        placed = with_text_bucket(df, order_text(df, names), "__range", buckets)
    ranked = global_rank(placed, bucket=["__range"], order=[quoted(n) for n in names], out="__rank")
    micros = (first_event - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    width = step // timedelta(microseconds=1)
    # NTZ arithmetic keeps the text independent of the session time zone.
    seconds = F.floor((F.lit(micros) + (F.col("__rank") - 1) * F.lit(width)) / F.lit(1_000_000)).cast("long")
    when = F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return ranked.withColumns({
        id_column: F.format_string(key_format, F.col("__rank")),
        time_column: F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }).drop("__rank", "__range")


def build_feature_source(df: DataFrame, table: MeasuredTable, order_key: str, **ids: object) -> DataFrame:
    """Key, event time, raw and derived features, and the label last, in a stable order."""
    require_columns(df, (order_key, *table.columns), "feature source")
    base = table.with_products(df.select(*[quoted(c) for c in dict.fromkeys((order_key, *table.columns))]))
    keyed = with_entity_ids(base, order_key, **ids)
    id_column = ids.get("id_column", "flower_id")
    time_column = ids.get("time_column", "event_timestamp")
    order = (id_column, time_column, *table.model_features, table.label)
    return keyed.select(*[quoted(c) for c in order])


def hot_keys(df: DataFrame, key: str, limit_rows: int | None = None) -> DataFrame:
    """Keys that alone hold more rows than one bucket's fair share.

    At most `bucket_target` keys can pass the default limit, so the result is always small.
    """
    if limit_rows is None:
        limit_rows = max(df.count() // bucket_target(df.sparkSession), 100_000)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > limit_rows)


def asof_lookup(
    spine: DataFrame,
    features: DataFrame,
    *,
    key: str,
    spine_time: str,
    feature_time: str,
    columns: Sequence[str],
    tie: str | None = None,
    max_age: timedelta | None = None,
    hot_limit_rows: int | None = None,
    time_buckets: int | None = None,
) -> DataFrame:
    """For each spine row the newest feature row of its key at or before its time.

    One shuffle on the key for ordinary keys. A key above the hot limit has its history cut into
    time slices; each slice starts from the last feature of the slices before it, so the answer is
    the same and no task sees the whole history. `tie` orders feature rows of equal key and time.
    """
    carried = [F.col(c) for c in columns]
    feature_row = F.struct(quoted(feature_time).alias("__ft"), *carried)
    tie_value = quoted(tie).cast("string") if tie else F.lit(None).cast("string")
    right = features.select(
        quoted(key).alias("__key"), quoted(feature_time).alias("__t"), F.lit(0).alias("__side"),
        tie_value.alias("__tie"), feature_row.alias("__f"),
    ).where(F.col("__key").isNotNull() & F.col("__t").isNotNull())
    spine_row = F.struct(*[quoted(c) for c in spine.columns])
    left = spine.select(
        quoted(key).alias("__key"), quoted(spine_time).alias("__t"), F.lit(1).alias("__side"),
        F.lit(None).cast("string").alias("__tie"), spine_row.alias("__s"),
    )
    both = right.unionByName(left, allowMissingColumns=True)
    order = [F.col("__t"), F.col("__side"), F.col("__tie")]

    hot = hot_keys(both.select("__key"), "__key", hot_limit_rows)
    hot = small_side(hot.select("__key", F.lit(True).alias("__hot")))
    if hot.isEmpty():
        window = Window.partitionBy("__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        seen = both.withColumn("__last", F.last("__f", ignorenulls=True).over(window))
    else:
        seen = _asof_in_slices(both, hot, order, time_buckets)

    last = F.col("__last")
    if max_age is not None:
        oldest = F.col("__t") - F.make_dt_interval(secs=F.lit(max_age.total_seconds()))
        last = F.when(last["__ft"] >= oldest, last)
    return (
        seen.where(F.col("__side") == 1)
        .withColumn("__hit", last)
        .select("__s.*", F.col("__hit.__ft").alias("feature_ts"),
                *[F.col(f"__hit.`{c}`").alias(f"feature_{c}") for c in columns])
    )


def _asof_in_slices(both: DataFrame, hot: DataFrame, order: list[Column], time_buckets: int | None) -> DataFrame:
    marked = both.join(hot, "__key", "left")
    clock = F.unix_micros(F.col("__t").cast("timestamp"))
    edges = range_edges(marked.where("__hot"), clock, time_buckets)
    sliced = with_range_bucket(marked, clock, edges, "__slice").withColumn(
        "__slice", F.when(F.col("__hot"), F.col("__slice")).otherwise(F.lit(-1))
    )
    cell = ["__key", "__slice"]
    ends = sliced.where("__hot").groupBy(*cell).agg(
        F.max_by("__f", F.when(F.col("__side") == 0, F.struct("__t", "__tie"))).alias("__end")
    )
    earlier = Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*cell, F.last("__end", ignorenulls=True).over(earlier).alias("__carry"))
    window = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = sliced.withColumn("__in", F.last("__f", ignorenulls=True).over(window))
    return seen.join(carry, cell, "left").withColumn("__last", F.coalesce("__in", "__carry"))


def latest_features(df: DataFrame, key: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Newest values per key. Partial aggregation folds a hot key on the map side, before the shuffle.

    Equal times are settled by the values themselves, so the answer is repeatable.
    """
    values = F.struct(*[quoted(c) for c in columns])
    newest = F.max(F.struct(quoted(time).alias("t"), values.alias("v")))
    return df.groupBy(key).agg(newest.alias("m")).select(
        key, F.col("m.t").alias(time), *[F.col(f"m.v.`{c}`").alias(c) for c in columns]
    )
