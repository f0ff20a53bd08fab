"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.classify import ROWS_PER_CLASS, Adam, labelled_sample, sigmoid, verdicts, with_scores
from marram.llm.tokens import IS_GAP, LOWER, chunks, mix

BUCKET_BITS = 20
# The vocabulary: subwords whose texts of the sample lean to one label by this many standard deviations.
# Others say nothing about toxicity, and their embeddings would only learn single texts by heart.
LEAN = 4.0
SIZES = (4, 5, 6)  # bytes; the gap before or after a word counts as one
WIDTH = 8
# The average is taken in units of a thirtieth: a few toxic words among very many subwords move it enough to be learned.
UNIT = 30.0
THRESHOLD = 0.7


def subwords(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: first row, bucket of every subword, and its document within the chunk, in document order."""
    for chunk in chunks(column):
        # A gap around each document, so its first and last word have an edge too.
        sizes = np.diff(chunk.offsets)
        buf = np.full(len(chunk.buf) + 2 * chunk.n_docs, 0x20, dtype=np.uint8)
        doc_of_byte = np.repeat(np.arange(chunk.n_docs), sizes)
        buf[np.arange(len(chunk.buf)) + 2 * doc_of_byte + 1] = LOWER[chunk.buf]
        doc = np.repeat(np.arange(chunk.n_docs), sizes + 2)
        gap = IS_GAP[buf]
        buf[gap] = 0x20
        wide = buf.astype(np.uint64)
        gaps = np.concatenate([[0], np.cumsum(gap)])
        codes, docs = [], []
        for n in SIZES:
            if len(buf) < n:
                continue
            m = len(buf) - n + 1
            code = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                code = (code << np.uint64(8)) | wide[k:k + m]
            inner = gaps[n - 1:n - 1 + m] - gaps[1:m + 1]  # gaps at places 1 .. n - 2
            good = np.flatnonzero((inner == 0) & ~(gap[:m] & gap[n - 1:]))
            codes.append((mix(code[good]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            docs.append(doc[good])
        code, of = np.concatenate([*codes, np.empty(0, np.int64)]), np.concatenate([*docs, np.empty(0, np.int64)])
        yield chunk.first_row, code.astype(np.int64), of.astype(np.int64)


@dataclass
class ToxicityModel:
    row: np.ndarray  # by bucket: row of its embedding, 0 for a subword outside the vocabulary
    embeddings: np.ndarray
    softmax: np.ndarray  # WIDTH x 2
    bias: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        """Softmax of the average over all subwords of a text, those outside the vocabulary counting as zero vectors.

        The layer is linear, so each bucket's share is computed once.
        """
        share = self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])
        share[0] = 0.0
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for first, code, doc in subwords(column):
            n = int(doc.max()) + 1 if len(doc) else 0
            total[first:first + n] += np.bincount(doc, weights=share[self.row[code]], minlength=n)
            count[first:first + n] += np.bincount(doc, minlength=n)
        return sigmoid(UNIT * total / np.maximum(count, 1) + self.bias[1] - self.bias[0])


def _vocabulary(bags: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """By bucket: 1, 2, ... for the subwords whose share of toxic texts is far from the sample's, else 0."""
    size = 1 << BUCKET_BITS
    n = [np.bincount(np.concatenate([b for b, t in zip(bags, y) if t == k] or [np.empty(0, np.int64)]), minlength=size)
         for k in (0, 1)]
    p, total = y.mean(), n[0] + n[1]
    lean = np.abs(n[1] - p * total) / np.sqrt(np.maximum(total * p * (1 - p), 1e-9))
    chosen = np.flatnonzero((lean >= LEAN) & (total > 1))
    row = np.zeros(size, dtype=np.int32)
    row[chosen] = np.arange(1, len(chosen) + 1)
    return row


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = 60, rate: float = 0.05, seed: int = 11) -> ToxicityModel:
    """Choose the vocabulary, then train embeddings and softmax together by Adam on mini-batches."""
    y = labels.astype(np.int64)
    rng = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    u, bias = rng.normal(0, 0.3, (WIDTH, 2)), np.zeros(2)
    model = ToxicityModel(np.zeros(size, dtype=np.int32), np.zeros((1, WIDTH)), u, bias)
    if len(np.unique(y)) < 2:
        return model
    bags = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(y)
    for first, code, doc in subwords(texts):
        keys, counts = np.unique(doc << BUCKET_BITS | code, return_counts=True)
        cuts = np.searchsorted(keys >> BUCKET_BITS, np.arange(int(doc.max(initial=-1)) + 2))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            bags[first + k] = keys[a:b] & (size - 1), counts[a:b]
    model.row = _vocabulary([b for b, _ in bags], y)
    bags = [(model.row[b][model.row[b] > 0], UNIT * c[model.row[b] > 0] / max(int(c.sum()), 1)) for b, c in bags]
    model.embeddings = e = rng.normal(0, 0.1, (int(model.row.max()) + 1, WIDTH))
    adam, order = Adam([e, u, bias], rate), np.arange(len(y))
    for _ in range(epochs):
        rng.shuffle(order)
        for low in range(0, len(order), 256):
            batch = order[low:low + 256]
            ids = np.concatenate([bags[k][0] for k in batch])
            weight = np.concatenate([bags[k][1] for k in batch])
            doc = np.repeat(np.arange(len(batch)), [len(bags[k][0]) for k in batch])
            pooled = np.stack([np.bincount(doc, weights=weight * e[ids, d], minlength=len(batch)) for d in range(WIDTH)], axis=1)
            logits = pooled @ u + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            back = p @ u.T
            grad = np.stack([np.bincount(ids, weights=weight * back[doc, d], minlength=len(e)) for d in range(WIDTH)], axis=1)
            adam.update([grad + 1e-5 * e, pooled.T @ p + 1e-4 * u, p.sum(axis=0)])
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.7) for every document.

    Fitted on a bounded sample of labelled texts. A null, empty or blank text has no subwords and scores by
    the bias alone; repeated rows get equal scores; without both labels all scores are near 0.5.
    """
    model = fit(*labelled_sample(docs, labels.select("doc_id", F.col("toxic").alias("label")), per_class))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return verdicts(with_scores(docs, lambda column: shared.value.score(column)), THRESHOLD)
