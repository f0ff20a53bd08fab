"""Scans: canonical tables, source chains, feature sets under a spec, request payloads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marram.functions.features import quoted, require_columns
from marram.schema import FeatureSetSpec, MeasuredTable
from marram.session import ensure_checkpoint_dir


def read_canonical_csv(spark: SparkSession, path: str, table: MeasuredTable,
                       extra: T.StructType | None = None) -> DataFrame:
    """CSV with header to the canonical columns, matched by header name.

    The header alone is looked at on the driver; the file's own column order and additional
    columns are respected, and absent columns are named before any row is read.
    """
    header = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in table.csv_schema()}
    types.update({f: T.DoubleType() for f in table.features})
    keep = tuple(extra.fieldNames()) if extra else ()
    if extra:
        types.update({f.name: f.dataType for f in extra})
    named = [table.rename.get(c, c) for c in header]
    absent = [c for c in (*keep, *table.columns) if c not in named]
    if absent:
        raise ValueError(f"CSV input lacks required columns: {absent}")
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return table.canonical(raw, keep)


@dataclass(frozen=True)
class Candidate:
    """One possible source: how it is described, where it is, how it is read."""

    description: str
    path: str | None = None
    format: str = "parquet"
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    build: Callable[[SparkSession], DataFrame] | None = None

    def open(self, spark: SparkSession) -> DataFrame:
        if self.build is not None:
            return self.build(spark)
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)


def resolve_source(spark: SparkSession, candidates: Sequence[Candidate], *, strict: bool = True,
                   describe_as: str = "source_description") -> DataFrame:
    """The first candidate that exists. Strict mode accepts the first candidate only.

    Only a missing path passes on to the next candidate; a source that exists but cannot be read
    is an error. The choice is recorded as a column.
    """
    if not candidates:
        raise ValueError("no source candidates given")
    tried = []
    for candidate in candidates[:1] if strict else candidates:
        try:
            opened = candidate.open(spark)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            tried.append(f"{candidate.description} ({candidate.path})")
            continue
        return opened.withColumn(describe_as, F.lit(candidate.description))
    raise FileNotFoundError("no source found; tried " + ", ".join(tried))


def asset_choice(mode: str, asset: Candidate, others: Sequence[Candidate]) -> list[Candidate]:
    """Candidates under the asset switch: `auto` tries the asset first, `true` demands it,
    `false` leaves it out."""
    if mode == "true":
        return [asset]
    if mode == "false":
        return list(others)
    if mode == "auto":
        return [asset, *others]
    raise ValueError(f"asset switch must be auto, true or false, not {mode!r}")


def enforce_spec(df: DataFrame, spec: FeatureSetSpec) -> DataFrame:
    """Typed columns of the spec plus `reject_reason`, NULL for rows that keep the contract.

    External text is cast with the try_ functions: a bad value marks its row, never fails the job.
    """
    require_columns(df, (*spec.index, spec.timestamp, *spec.features), f"feature set {spec.name}")
    text = lambda c: quoted(c).cast("string")
    parsed = F.try_to_timestamp(text(spec.timestamp), F.lit(spec.timestamp_format)).cast("timestamp_ntz")
    typed = df.select(
        *[quoted(c) for c in spec.index],
        text(spec.timestamp).alias("__when"), parsed.alias(spec.timestamp),
        *[text(c).alias(f"__t_{i}") for i, c in enumerate(spec.features)],
        *[quoted(c).try_cast(t).alias(c) for c, t in spec.features.items()],
    )
    reason = F.lit(None).cast("string")
    for i, c in reversed(list(enumerate(spec.features))):
        broken = F.col(f"__t_{i}").isNotNull() & quoted(c).isNull()
        reason = F.when(broken, F.lit(f"type:{c}")).otherwise(reason)
    reason = F.when(quoted(spec.timestamp).isNull(), F.lit("timestamp")).otherwise(reason)
    for c in reversed(spec.index):
        reason = F.when(quoted(c).isNull() | (text(c) == ""), F.lit(f"index:{c}")).otherwise(reason)
    return typed.withColumn("reject_reason", reason).select(
        *[quoted(c) for c in (*spec.index, spec.timestamp, *spec.features)], "reject_reason"
    )


def read_feature_set(spark: SparkSession, spec: FeatureSetSpec, path: str | None = None,
                     format: str = "csv") -> tuple[DataFrame, DataFrame]:
    """(kept rows, quarantined rows) of a feature file. CSV columns are matched by header name."""
    where = path or spec.path
    if where is None:
        raise ValueError(f"feature set {spec.name} has no path")
    reader = spark.read.format(format)
    if format == "csv":
        header = spark.read.option("header", True).csv(where).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        reader = reader.option("header", True).schema(schema)
    checked = enforce_spec(reader.load(where), spec)
    kept = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return kept, checked.where(F.col("reject_reason").isNotNull())


# Equal bodies of a file are counted and numbered in so many parts.
BODY_PARTS = 64


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Payload text, one request per line, with an id made of the file, the body and its number among equal bodies.

    Equal lines of a file are alike, so only how many there are matters: they are counted in parts, on the map side first, and the
    counts are spread out again with running numbers. Ids are distinct, and the same for any split of the files.
    """
    lines = spark.read.schema("value string").text(path)
    keyed = lines.select(F.col("value").alias("raw_data"), body_key(), F.pmod(F.monotonically_increasing_id(), F.lit(BODY_PARTS)).alias("part"))
    # Written once: where a line's part was drawn, its count is final.
    ensure_checkpoint_dir(spark)
    counts = keyed.groupBy("key", "raw_data", "part").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    upto = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)  # at most 64 rows
    numbered = counts.withColumn("upto", F.sum("n").over(upto))
    # The parts of a crowded body are spread out by different tasks.
    rows = numbered.repartition("key", "part").select("raw_data", "key", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("number"))
    return rows.select("raw_data", request_id(F.col("key"), F.col("number")))


def body_key() -> Column:
    return F.md5(F.concat_ws(":", "_metadata.file_path", "value")).alias("key")


def request_id(key: Column, number: Column) -> Column:
    return F.md5(F.concat_ws(":", key, number.cast("string"))).alias("request_id")


class _Counter(StatefulProcessor):
    """How many equal bodies have been seen, per key; every row takes the next number."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues):
        state = self.seen.get() if self.seen.exists() else None
        n = state[0] if state else 0
        for part in rows:
            yield pd.DataFrame({"key": key[0], "raw_data": part["raw_data"], "number": range(n + 1, n + 1 + len(part))})
            n += len(part)
        self.seen.update((n,))

    def close(self) -> None:
        pass


def stream_requests(spark: SparkSession, path: str) -> DataFrame:
    """The same ids on a stream of payload files: a counter per file and body carries on from batch to batch."""
    lines = spark.readStream.schema("value string").text(path)
    keyed = lines.select(F.col("value").alias("raw_data"), body_key())
    numbered = keyed.groupBy("key").transformWithStateInPandas(
        _Counter(), "key string, raw_data string, number long", "append", "None")
    return numbered.select("raw_data", request_id(F.col("key"), F.col("number")))
