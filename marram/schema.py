"""Declared shapes: a measured, labelled table and a keyed, timestamped feature set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marram.functions.features import add_products, quoted, require_columns


@dataclass(frozen=True)
class MeasuredTable:
    """k numeric measurements, a class label, and the product features built from them."""

    features: tuple[str, ...]
    label: str
    codes: Mapping[str, int] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    products: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def model_features(self) -> tuple[str, ...]:
        return (*self.features, *self.products)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.features, self.label)

    def canonical(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Rename, check, and select in the fixed order; `keep` carries row keys along."""
        named = df.withColumnsRenamed(dict(self.rename))
        require_columns(named, (*keep, *self.columns), "measured table")
        return named.select(*[quoted(c) for c in (*keep, *self.columns)])

    def with_products(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.features, "measured table")
        return add_products(df, self.products)

    def model_frame(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return self.with_products(df).select(*[quoted(c) for c in (*keep, *self.model_features)])

    def csv_schema(self) -> T.StructType:
        """Types of the raw file, under the names it uses before renaming."""
        raw = {new: old for old, new in self.rename.items()}
        fields = [T.StructField(raw.get(c, c), T.DoubleType()) for c in self.features]
        return T.StructType([*fields, T.StructField(self.label, T.StringType())])


# Column names, class codes and derived columns of the flower table.
FLOWERS = MeasuredTable(
    features=(
        "sepal length (cm)",
        "sepal width (cm)",
        "petal length (cm)",
        "petal width (cm)",
    ),
    label="species",
    codes={"setosa": 0, "versicolor": 1, "virginica": 2},
    rename={
        "sepal_length": "sepal length (cm)",
        "sepal_width": "sepal width (cm)",
        "petal_length": "petal length (cm)",
        "petal_width": "petal width (cm)",
    },
    products={
        "sepal length squared": ("sepal length (cm)", "sepal length (cm)"),
        "petal length squared": ("petal length (cm)", "petal length (cm)"),
        "sepal area (cm^2)": ("sepal length (cm)", "sepal width (cm)"),
        "petal area (cm^2)": ("petal length (cm)", "petal width (cm)"),
        "sepal length x petal length": ("sepal length (cm)", "petal length (cm)"),
    },
)

# Fixed value: the text form of event times in feature files.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


@dataclass(frozen=True)
class FeatureSetSpec:
    """What a feature file must hold: index columns, an event time in text, typed features."""

    name: str
    index: tuple[str, ...]
    features: Mapping[str, str]
    timestamp: str = "event_timestamp"
    timestamp_format: str = ISO_SECONDS
    version: str = "1"
    entity: str = "flower"
    entity_version: str = "1"
    path: str | None = None

    def text_schema(self) -> T.StructType:
        """All columns as text: every type is then enforced row by row, never by the reader."""
        names = [*self.index, self.timestamp, *self.features]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    @classmethod
    def of(cls, df: DataFrame, name: str, index: tuple[str, ...], timestamp: str = "event_timestamp",
           **more: str) -> "FeatureSetSpec":
        """Derive the spec from a built feature table."""
        taken = {*index, timestamp}
        features = {f.name: f.dataType.simpleString() for f in df.schema if f.name not in taken}
        return cls(name=name, index=tuple(index), features=features, timestamp=timestamp, **more)
