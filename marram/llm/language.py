"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.classify import Adam, labelled_sample, sigmoid
from marram.llm.tokens import IS_GAP, LOWER, chunks, is_held_out, mix

BUCKETS = 1 << 12
SIZES = (1, 2, 3)  # bytes
ROWS_PER_LANGUAGE = 800
UNKNOWN = "und"
# Texts whose two nearest codewords are closer than this in probability are flagged.
AMBIGUOUS = 0.2


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of +1 and -1, far apart: the best of some random draws by least distance."""
    rng = np.random.default_rng(seed)
    bits = max(15, 6 * int(np.ceil(np.log2(max(n, 2)))))
    best, best_distance = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], size=(n, bits))
        balanced = (np.abs(code.sum(axis=0)) < n).all() or n == 1
        gram = code @ code.T - 2 * bits * np.eye(n, dtype=np.int64)
        distance = (bits - gram.max()) // 2 if balanced else 0
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def grams(column: pa.Array) -> np.ndarray:
    """Hashed byte n-gram counts of each text as unit vectors; ASCII is lower-cased, gaps are one space."""
    out = np.zeros((len(column), BUCKETS), dtype=np.float32)
    for chunk in chunks(column):
        buf = LOWER[chunk.buf]
        buf[IS_GAP[chunk.buf]] = 0x20
        wide = buf.astype(np.uint64)
        per_size = []
        for n in SIZES:
            m = max(len(buf) - n + 1, 0)
            code = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                code = (code << np.uint64(8)) | wide[k:k + m]
            per_size.append((mix(code) >> np.uint64(52)).astype(np.int64))
        for k in range(chunk.n_docs):
            low, high = int(chunk.offsets[k]), int(chunk.offsets[k + 1])
            counts = np.zeros(BUCKETS)
            for n, codes in zip(SIZES, per_size):
                if high - low >= n:
                    counts += np.bincount(codes[low:high - n + 1], minlength=BUCKETS)
            counts = np.sqrt(counts)
            out[chunk.first_row + k] = counts / max(np.linalg.norm(counts), 1e-9)
    return out


@dataclass
class LanguageModel:
    names: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Loss-weighted decoding: each codeword's loss over all bits, as probabilities."""
        f = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -f * row) * self.trust).sum(axis=1) for row in self.code], axis=1)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return p / p.sum(axis=1, keepdims=True)


def fit(texts: pa.Array, labels: np.ndarray, steps: int = 150) -> LanguageModel | None:
    """One logistic classifier per bit of the codewords; bits that are learned badly count less."""
    names = sorted(set(labels.tolist()))
    if not names:
        return None
    x = grams(texts).astype(np.float64)
    code = codewords(len(names))
    target = code[np.searchsorted(np.array(names, dtype=object), labels)]
    w, b = np.zeros((BUCKETS, code.shape[1])), np.zeros(code.shape[1])
    adam = Adam([w, b], 0.5)
    for _ in range(steps):
        f = x @ w + b
        e = -target * sigmoid(-target * f) / len(x)
        adam.update([x.T @ e + 1e-6 * w, e.sum(axis=0)])
    right = ((x @ w + b) * target > 0).mean(axis=0)
    return LanguageModel(names, code, w.astype(np.float32), b.astype(np.float32), np.maximum(2 * right - 1, 0.05))


def language_report(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every document.

    A null text, or one without a letter, is `und` with score 0. Fitted on about `per_language` labelled rows
    of each language; null languages are never learned. Without any labelled row everything is `und`. Texts
    are read whole; repeated rows get equal answers.
    """
    model = fit(*labelled_sample(docs, docs.select("doc_id", F.col("lang").alias("label")), per_language))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = docs.select("doc_id", F.when(F.rlike("text", F.lit(r"\p{L}")), F.col("text")).alias("text"))
    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                names, score, close = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                if shared.value is not None:
                    p = shared.value.probabilities(grams(part.column(1)))
                    top = np.sort(p, axis=1)
                    lettered = np.asarray(part.column(1).is_valid())
                    names = [shared.value.names[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1), lettered)]
                    score = np.where(lettered, top[:, -1], 0.0)
                    close = lettered & (top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0.0) < AMBIGUOUS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, type=pa.string()), pa.array(score), pa.array(close)], names=schema.names)

    return inner.mapInArrow(run, schema).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
