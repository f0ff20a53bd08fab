"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.classify import ROWS_PER_CLASS, Adam, labelled_sample, sigmoid, verdicts, with_scores
from marram.llm.tokens import LOWER, chunks, find_words, hash_spans

VOCABULARY = 1 << 15  # hashed word ids
SHAPES = 256  # the word's look: marks, case, repetition, length
WIDTH = 64
NONZERO = 8
CONTEXT = 2
HIDDEN = 32
THRESHOLD = 0.5

# Bits of a word's look that any of its bytes sets; a second capital, repetition and length are the others.
_LOOK = np.zeros(256, dtype=np.uint8)
for _bit, _chars in ((0, b"#*$%&|<>"), (2, b"abcdefghijklmnopqrstuvwxyz"), (3, b"!"), (5, b".,;:?"), (6, b"0123456789")):
    _LOOK[list(_chars)] |= 1 << _bit
_UPPER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")).astype(np.int32)


def word_ids(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, each document's first word (one more at the end), hashed ids and shapes of the words."""
    for chunk in chunks(column):
        words = find_words(chunk)
        if not len(words.start):
            yield chunk.first_row, words.first, np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        low = LOWER[chunk.buf]
        hashes = hash_spans(low, words.start, words.end)
        # What lies between two words sets no bit, so a word's bytes reach up to the next word's.
        look = np.bitwise_or.reduceat(_LOOK[chunk.buf], words.start).astype(np.int64)
        capitals = np.add.reduceat(_UPPER[chunk.buf], words.start)
        same = np.zeros(len(hashes), dtype=bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
        shape = (look | (capitals > 1).astype(np.int64) << 1 | same.astype(np.int64) << 4
                 | (words.end - words.start > 6).astype(np.int64) << 7)
        yield chunk.first_row, words.first, (hashes % np.uint64(VOCABULARY)).astype(np.int64), shape


def index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors, NONZERO entries of +1 or -1 each."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    places = np.argsort(rng.random((n, WIDTH)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1.0, 1.0], dtype=np.float32), size=(n, NONZERO)), axis=1)
    return out


def _entries(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each index vector's NONZERO entries."""
    places = np.nonzero(index)[1].reshape(len(index), NONZERO)
    return places, np.take_along_axis(index, places, axis=1).astype(np.float64)


def context_sums(columns: Iterable[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The index vectors around every word and every shape, summed over all texts. Whole numbers, so any order gives the same."""
    entries = [_entries(index_vectors(VOCABULARY, 1)), _entries(index_vectors(SHAPES, 2))]
    tables = np.zeros(VOCABULARY * WIDTH), np.zeros(SHAPES * WIDTH)
    for column in columns:
        for _, first, w, s in word_ids(column):
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for (places, signs), ids, table in zip(entries, (w, s), tables):
                for step in range(1, CONTEXT + 1):
                    if len(ids) > step:
                        near = doc[step:] == doc[:-step]
                        left, right = ids[:-step][near], ids[step:][near]
                        for own, other in ((left, right), (right, left)):
                            table += np.bincount((own[:, None] * WIDTH + places[other]).ravel(), weights=signs[other].ravel(),
                                                 minlength=len(table))
    return tuple(t.reshape(-1, WIDTH) for t in tables)


def unit_vectors(sums: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Random indexing: a word's vector is its own index vector plus those of the words around it, summed, unit length."""
    tables = index_vectors(VOCABULARY, 1) + sums[0], index_vectors(SHAPES, 2) + sums[1]
    return tuple((t / np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1e-9)).astype(np.float32) for t in tables)


def corpus_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word and shape vectors from all documents: each task sums its own, and the sums are merged by id, a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.concatenate(context_sums(batch.column(0) for batch in batches))
        ids = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(sums[ids, k]) for k in range(WIDTH))], names=names)

    names = ["id", *(f"d{k}" for k in range(WIDTH))]
    parts = docs.select("text").mapInArrow(run, ", ".join(["id long", *(f"{c} double" for c in names[1:])]))
    table = parts.groupBy("id").agg(*(F.sum(c).alias(c) for c in names[1:])).toArrow()
    sums = np.zeros((VOCABULARY + SHAPES, WIDTH))
    sums[table.column("id").to_numpy()] = np.stack([table.column(c).to_numpy() for c in names[1:]], axis=1)
    return unit_vectors((sums[:VOCABULARY], sums[VOCABULARY:]))


@dataclass
class QualityModel:
    words: np.ndarray
    shapes: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    _shares: tuple | None = None

    def pooled(self, column: pa.Array) -> np.ndarray:
        """Mean word vector and mean shape vector of each text, and the log of its word count."""
        out = np.zeros((len(column), 2 * WIDTH + 1), dtype=np.float32)
        for row, first, w, s in word_ids(column):
            n = np.diff(first)
            full = np.flatnonzero(n)
            if not len(full):
                continue
            rows = row + full
            for low, table, ids in ((0, self.words, w), (WIDTH, self.shapes, s)):
                out[rows, low:low + WIDTH] = np.add.reduceat(table[ids], first[full], axis=0) / n[full, None]
            out[rows, -1] = np.log1p(n[full])
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((pooled - self.mean) / self.scale) @ w1 + b1) @ w2 + b2[0]

    def score(self, column: pa.Array) -> np.ndarray:
        """The network over the pooled vectors. Pooling and the first layer are linear, so each word's share is computed once."""
        w1, b1, w2, b2 = self.layers
        if self._shares is None:
            first = w1 / self.scale[:, None]
            self._shares = ((self.words @ first[:WIDTH]).astype(np.float32), (self.shapes @ first[WIDTH:2 * WIDTH]).astype(np.float32),
                            first[-1], b1 - self.mean @ first)
        words, shapes, length, base = self._shares
        hidden = np.tile(base, (len(column), 1))
        for row, first, w, s in word_ids(column):
            n = np.diff(first)
            full = np.flatnonzero(n)
            if len(full):
                summed = np.add.reduceat(words[w] + shapes[s], first[full], axis=0)
                hidden[row + full] += summed / n[full, None] + np.log1p(n[full])[:, None] * length
        return sigmoid((np.tanh(hidden) @ w2 + b2[0]) / self.temperature).astype(np.float64)


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = 60, seed: int = 7,
        vectors: tuple[np.ndarray, np.ndarray] | None = None) -> QualityModel:
    """Train on four fifths of the sample and set the temperature on the rest. One class or none: scores of 0.5 or that class."""
    y = labels.astype(np.float64)
    words, shapes = vectors or unit_vectors(context_sums([texts]))
    model = QualityModel(words, shapes, np.zeros(2 * WIDTH + 1), np.ones(2 * WIDTH + 1), [], 1.0)
    x = model.pooled(texts).astype(np.float64)
    rng = np.random.default_rng(seed)
    w1 = rng.normal(0, 0.1, (x.shape[1], HIDDEN))
    model.layers = [w1, np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
    if not len(y):
        return model
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    model.layers[2] += rng.normal(0, 0.1, HIDDEN)
    order = rng.permutation(len(y))
    held, train = order[:len(y) // 5], order[len(y) // 5:]
    z, adam = (x - model.mean) / model.scale, Adam(model.layers, 0.005)
    for _ in range(epochs):
        rng.shuffle(train)
        for low in range(0, len(train), 64):
            k = train[low:low + 64]
            h = np.tanh(z[k] @ model.layers[0] + model.layers[1])
            e = (sigmoid(h @ model.layers[2] + model.layers[3][0]) - y[k]) / len(k)
            back = np.outer(e, model.layers[2]) * (1 - h * h)
            adam.update([z[k].T @ back + 1e-4 * model.layers[0], back.sum(axis=0), h.T @ e, np.array([e.sum()])])
    if len(held):
        logits = model.logits(x[held])
        grid = np.geomspace(0.25, 8, 41)
        loss = [np.mean(np.logaddexp(0, -logits / t) * y[held] + np.logaddexp(0, logits / t) * (1 - y[held])) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; null and empty texts score as text without words.

    Word vectors come from all documents; the network is fitted on a bounded sample (see `labelled_sample`), reading text only. Repeated rows get equal scores;
    without labels all scores are 0.5.
    """
    model = fit(*labelled_sample(docs, labels.select("doc_id", F.col("quality").alias("label")), per_class), vectors=corpus_vectors(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return verdicts(with_scores(docs, lambda column: shared.value.score(column)), THRESHOLD)
