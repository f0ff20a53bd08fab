"""A forest whose trees were grown inside tasks, as a stage of saved pipelines.

The library's own model keeps an object with class counts for every node in the driver's JVM, about 300 bytes each, once per copy and per load.
Here a tree is four packed arrays in a row of a table, about 10 bytes a node; a job that scores rows sends them to its tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.operators.growth import unpacked


class Packed:
    """All trees of a forest, each in its own few arrays."""

    def __init__(self, table: pa.Table, classes: int):
        self.classes, self.trees = classes, []
        table = table.sort_by("tree")
        names = ("cut", "feature", "threshold", "counts")
        for nodes, *packed in zip(*(table.column(n) for n in ("nodes", *names))):
            nodes, tree = nodes.as_py(), {n: v.as_buffer() for n, v in zip(names, packed)}
            inner = nodes // 2
            cut = np.unpackbits(np.frombuffer(tree["cut"], dtype=np.uint8), count=nodes).astype(bool)
            self.trees.append((cut, unpacked(tree["feature"], inner), np.frombuffer(tree["threshold"]),
                               unpacked(tree["counts"], (inner + 1) * classes).reshape(-1, classes)))

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Class chances of each row: the mean over all trees of the shares in the leaf where it ends."""
        sums = np.zeros((len(x), self.classes))
        for cut, feature, threshold, counts in self.trees:
            place = np.where(cut, np.cumsum(cut), np.cumsum(~cut)) - 1  # of a node among those cut, of a leaf among the leaves
            end, going = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
            while len(going):
                going = going[cut[end[going]]]
                now = place[end[going]]
                end[going] = 2 * now + 1 + ~(x[going, feature[now]] <= threshold[now])
            own = counts[place[end]].astype(float)
            sums += own / np.maximum(own.sum(axis=1, keepdims=True), 1)
        return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-300)


class GrownForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, MLReadable, MLWritable):
    """Adds class chances and the likeliest class, the first among equals, as the library's forests do."""

    numClasses = Param(Params._dummy(), "numClasses", "number of classes", TypeConverters.toInt)

    def __init__(self, trees: DataFrame | None = None, classes: int | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self._trees_table, self._shared = trees, None
        if classes is not None:
            self._set(numClasses=classes)

    @property
    def trees_table(self) -> DataFrame:
        """One row per tree (`growth.TREE_SCHEMA`)."""
        return self._trees_table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._shared is None:
            packed = Packed(self._trees_table.toArrow(), self.getOrDefault(self.numClasses))
            self._shared = dataset.sparkSession.sparkContext.broadcast(packed)
        shared = self._shared

        @F.arrow_udf("array<double>")
        def chances(x: pa.Array) -> pa.Array:
            found = shared.value.chances(np.asarray(x.flatten()).reshape(len(x), -1))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * found.shape[1], type=pa.int32()), pa.array(found.ravel()))

        told = dataset.withColumn("__chances", chances(vector_to_array(self.getFeaturesCol())))
        best = F.array_position("__chances", F.array_max("__chances")) - 1
        return told.withColumns({
            self.getProbabilityCol(): array_to_vector("__chances"), self.getPredictionCol(): best.cast("double")}).drop("__chances")

    def copy(self, extra=None) -> GrownForestModel:
        again = super().copy(extra)
        again._trees_table, again._shared = self._trees_table, self._shared
        return again

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: GrownForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.trees_table.write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> GrownForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/trees"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
