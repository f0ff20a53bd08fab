"""What the classifiers share: a bounded sample of labelled texts, and scoring of whole tables in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.tokens import is_held_out

# The documented bound on what a classifier is fitted on: about this many labelled rows of each class.
ROWS_PER_CLASS = 2000
# However many classes there are, about so many rows in all.
ROWS_IN_ALL = 8000


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> tuple[pa.Array, np.ndarray]:
    """(texts, labels) of about `per_class` rows of each label, sorted by id; held-out ids are never among them.

    `labels` has rows (doc_id, label); of several for one id the greatest counts; nulls are left out. The
    choice depends on ids alone: a row is in if the hash of its id falls under its class's share. Only the
    chosen ids are joined to the texts, and their number is bounded, so they are broadcast. An id with several
    texts counts once, with the text that comes first by hash.
    """
    known = labels.where("doc_id is not null and label is not null").where(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    most = min(per_class, ROWS_IN_ALL / max(1, known.select("label").distinct().count()))
    shares = known.groupBy("label").agg((most / F.count(F.lit(1))).alias("share"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    ids = known.join(F.broadcast(shares), "label").where(place < F.col("share")).select(
        F.col("doc_id").alias("_labelled_id"), "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_labelled_id"))
    once = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64(F.coalesce("text", F.lit("")))).alias("text"))
    table = once.toArrow().sort_by([("doc_id", "ascending")])
    return (table.column("text").combine_chunks().cast(pa.large_string()),
            np.array(table.column("label").to_pylist(), dtype=object))


def with_scores(docs: DataFrame, score: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Append `score` (double) to (doc_id, text) and leave the text out; every text is scored whole."""
    inner = docs.select("doc_id", "text")
    schema = docs.select("doc_id").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1)))], names=["doc_id", "score"])

    return inner.mapInArrow(run, schema)


def verdicts(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


class Adam:
    """Adam steps on a list of arrays."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.step = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def update(self, grads: list[np.ndarray]) -> None:
        self.step += 1
        for a, g, m, v in zip(self.arrays, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= self.rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
