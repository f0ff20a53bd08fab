"""Preprocessing stages: product features, population scaling, and their pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions.features import add_products, quoted
from marram.schema import MeasuredTable


class ProductFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `names[i] = left[i] * right[i]`, replacing columns of those names."""

    names = Param(Params._dummy(), "names", "new columns", TypeConverters.toListString)
    left = Param(Params._dummy(), "left", "first factors", TypeConverters.toListString)
    right = Param(Params._dummy(), "right", "second factors", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names=None, left=None, right=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, table: MeasuredTable) -> "ProductFeatures":
        pairs = list(table.products.values())
        return cls(names=list(table.products), left=[a for a, _ in pairs], right=[b for _, b in pairs])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        triples = zip(self.getOrDefault("names"), self.getOrDefault("left"), self.getOrDefault("right"))
        return add_products(dataset, {n: (a, b) for n, a, b in triples})


class _ScalerColumns(Params):
    inputs = Param(Params._dummy(), "inputs", "columns to scale", TypeConverters.toListString)
    outputs = Param(Params._dummy(), "outputs", "scaled columns", TypeConverters.toListString)


class PopulationScaler(Estimator, _ScalerColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Zero mean and unit population variance; a constant column becomes 0.

    The built-in scaler divides by the sample deviation, which is not the same number.
    """

    @keyword_only
    def __init__(self, *, inputs=None, outputs=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        inputs = self.getOrDefault("inputs")
        aggs = []
        for i, c in enumerate(inputs):
            v = quoted(c).cast("double")
            constant = F.min(v) == F.max(v)
            aggs.append(F.when(constant, F.min(v)).otherwise(F.avg(v)).alias(f"m{i}"))
            aggs.append(F.when(constant, F.lit(1.0)).otherwise(F.stddev_pop(v)).alias(f"s{i}"))
        row = dataset.agg(*aggs).first()
        if any(row[f"m{i}"] is None for i in range(len(inputs))):
            raise ValueError("cannot scale a table without values")
        return PopulationScalerModel(
            inputs=inputs, outputs=self.getOrDefault("outputs"),
            means=[row[f"m{i}"] for i in range(len(inputs))], scales=[row[f"s{i}"] for i in range(len(inputs))],
        )


class PopulationScalerModel(Model, _ScalerColumns, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "column divisors", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputs=None, outputs=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = zip(*[self.getOrDefault(p) for p in ("inputs", "outputs", "means", "scales")])
        return dataset.withColumns({
            out: (quoted(c).cast("double") - F.lit(m)) / F.lit(s) for c, out, m, s in stats
        })


def scaled_name(column: str) -> str:
    return f"scaled {column}"


def preprocessing_stages(table: MeasuredTable, use_scaling: bool = False, features_col: str = "features") -> list:
    """Product features, then the vector; with scaling its inputs are the scaled columns."""
    inputs = list(table.model_features)
    stages: list = [ProductFeatures.of(table)] if table.products else []
    if use_scaling:
        outputs = [scaled_name(c) for c in inputs]
        stages.append(PopulationScaler(inputs=inputs, outputs=outputs))
        inputs = outputs
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid="error")]


def preprocessing_pipeline(table: MeasuredTable, use_scaling: bool = False) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(table, use_scaling))
