"""The daily monitor: one day of collected inputs and outputs against a baseline."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.operators import drift, profiles
from marram.sources.sinks import read_collection

DAY_END = time(3, 15)  # fixed value: the monitor runs at 03:15 on the day before it


def monitor_daily(
    spark: SparkSession,
    collections: str,
    baseline: DataFrame,
    features: Sequence[str],
    label: str,
    day: date,
    out: str,
    *,
    bins: int = 10,
) -> dict[str, DataFrame]:
    """Write drift, quality and profile tables for the 24 hours up to 03:15 of `day`.

    The baseline has the features and the label column. Bin edges and bounds come from it, so they
    stay the same from day to day.
    """
    end = datetime.combine(day, DAY_END)
    start = end - timedelta(days=1)
    inside = (F.col("collected_at") >= F.lit(start)) & (F.col("collected_at") < F.lit(end))
    inputs, outputs = (side.where(inside) for side in read_collection(spark, collections))

    both = _stack(baseline, inputs, features)
    marks = profiles.exact_quantiles(baseline, features, [i / bins for i in range(1, bins)]).collect()
    edges = {f: sorted({m.value for m in marks if m.feature == f}) for f in features}
    exact = [drift.exact_drift(both, f, F.col("current")) for f in features]
    tall = exact[0]
    for part in exact[1:]:
        tall = tall.unionByName(part)
    shares = _stack(baseline.select(quoted(label).alias("predicted_label")), outputs, ["predicted_label"])
    tables = {
        "drift_binned": drift.binned_drift(both, F.col("current"), edges),
        "drift_exact": tall,
        "prediction_drift": drift.categorical_drift(shares, "predicted_label", F.col("current")),
        "data_quality": profiles.data_quality(inputs, features, profiles.value_bounds(baseline, features)),
        "profile": profiles.feature_profile(inputs, features, exact=False),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}/monitor_day={day:%Y-%m-%d}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}


def _stack(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    pick = lambda df, flag: df.select(*[quoted(c) for c in columns], F.lit(flag).alias("current"))
    return pick(old, False).unionByName(pick(new, True))
