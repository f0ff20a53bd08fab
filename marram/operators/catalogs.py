"""Questions about tables of versions, runs, jobs and traffic. Top-1 is an aggregate, never a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marram.functions.features import quoted


def next_version(df: DataFrame, asset: str, version: str) -> DataFrame:
    """Highest numeric version plus one, as text; text versions are ignored; `1` when none counts."""
    top = F.coalesce(F.max(quoted(version).try_cast("long")), F.lit(0).cast("long"))
    return df.groupBy(asset).agg((top + 1).cast("string").alias("next_version"))


def latest_version(df: DataFrame, asset: str, version: str, rule: str = "text_last_wins") -> DataFrame:
    """The newest version per asset.

    `text_last_wins`: any text version beats every number. `numeric_only`: text is ignored, NULL
    when no version is a number.
    """
    number = quoted(version).try_cast("long")
    is_text = number.isNull()
    if rule == "numeric_only":
        newest = F.max(number).cast("string")
    elif rule == "text_last_wins":
        text = F.when(is_text, quoted(version))
        newest = F.max(F.struct(is_text.alias("t"), number.alias("n"), text.alias("s"),
                                quoted(version).alias("v")))["v"]
    else:
        raise ValueError(f"unknown rule: {rule}")
    return df.groupBy(asset).agg(newest.alias("latest_version"))


def latest_by(df: DataFrame, time: str, tie: str, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest (time, tie), overall or per group: one small state per group."""
    newest = F.max(F.struct(quoted(time).alias("t"), quoted(tie).alias("k"),
                            F.struct(*[quoted(c) for c in columns]).alias("row")))
    picked = df.groupBy(*group).agg(newest.alias("m")).where(F.col("m").isNotNull())
    return picked.select(*group, "m.row.*")


def require_latest(df: DataFrame, time: str, tie: str, columns: Sequence[str], what: str = "run") -> dict:
    row = latest_by(df, time, tie, columns).first()
    if row is None:
        raise LookupError(f"no {what} found")
    return row.asDict()


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """One example row: the one with the smallest key."""
    return df.orderBy(quoted(key)).limit(1)


def traffic_shares(df: DataFrame, endpoint: str, deployment: str, traffic: str, target: str) -> DataFrame:
    """Traffic of one deployment per endpoint, and the shares left once it is removed.

    What stays keeps its number; when nothing else is left the target stays with 0. Shares are
    also given relative to what is left.
    """
    per = df.groupBy(endpoint, deployment).agg(F.sum(traffic).cast("long").alias("t"))
    is_target = quoted(deployment) == target
    own = Window.partitionBy(endpoint)
    rest = F.sum(F.when(~is_target, F.col("t"))).over(own)
    seen = per.withColumns({
        "target_traffic": F.coalesce(F.max(F.when(is_target, F.col("t"))).over(own), F.lit(0).cast("long")),
        "rest": F.coalesce(rest, F.lit(0).cast("long")),
        "alone": F.count_if(~is_target).over(own) == 0,
    }).where(~is_target | F.col("alone"))
    left = F.when(is_target, F.lit(0).cast("long")).otherwise(F.col("t"))
    return seen.select(
        endpoint, "target_traffic", (F.col("target_traffic") > 0).alias("has_traffic"), deployment,
        left.alias("traffic_left"),
        F.when(F.col("rest") > 0, left / F.col("rest")).otherwise(F.lit(0.0)).alias("share_left"),
    )
