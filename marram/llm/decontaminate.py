"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marram.llm.simhash import BITS
from marram.llm.tokens import LOWER, Chunk, Words, chunks, find_words, hash_spans, mix

SHINGLE = 5
SIMILARITY = 0.8
# Texts that are 0.8 alike differ in about 10 of 64 bits, with a deviation of 3.
RADIUS = 23
BLOCKS, BLOCK_BITS = 8, 8
# Benchmark text indexed at once. A larger benchmark is matched in as many blocks as it takes.
INDEX_BYTES = 4 << 20
FILTER_BITS = 22

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
    T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())]))

STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of `size` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += words[k:k + n] * STEPS[k]
    return mix(total)


def expand(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges low:high, one range after the other."""
    n = high - low
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def window_prints(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """SimHash of hashes[low:high] for windows whose two ends never go back: a bit is 1 if set in over half.

    Bits are summed along the hashes that some window holds, each taken once, so overlapping windows cost a
    subtraction each and not their length.
    """
    high = np.maximum(high, low)
    fresh = low.copy()
    fresh[1:] = np.maximum(low[1:], high[:-1])
    rows = hashes[expand(fresh, np.maximum(high, fresh))]
    bits = np.unpackbits(rows.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(rows) + 1, BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    stop, size = np.cumsum(np.maximum(high - fresh, 0)), high - low
    over = (sums[stop] - sums[stop - size]) * 2 > size[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of least over sum of greatest counts."""
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def _lower_chunk(chunk: Chunk) -> tuple[np.ndarray, Words]:
    return LOWER[chunk.buf], find_words(chunk)


@dataclass
class SizeIndex:
    """Items of one size. For each block value, the items with a block within two bits of it."""

    size: int
    shingle: int
    items: np.ndarray
    prints: np.ndarray
    starts: np.ndarray  # blocks x 257
    lists: list[np.ndarray]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius: with 8 blocks and 23 bits, one block differs in at most 2."""
        found = []
        blocks = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BLOCKS)
        for b in range(BLOCKS):
            low = self.starts[b][blocks[:, b]]
            n = self.starts[b][blocks[:, b].astype(np.int64) + 1] - low
            window = np.repeat(np.arange(len(prints)), n)
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            found.append(window * len(self.items) + self.lists[b][place])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.items), pairs % len(self.items)
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near], item[near]


class BenchmarkIndex:
    """Fingerprints of a bounded number of benchmark items by size, and the shingles they hold."""

    def __init__(self, ids: list[int], texts: list[str]):
        column = pa.array([t or "" for t in texts], type=pa.string())
        words, hashes = [], []
        for chunk in chunks(column):
            low, w = _lower_chunk(chunk)
            h = hash_spans(low, w.start, w.end)
            flat = low.tobytes()
            for k in range(chunk.n_docs):
                a, b = w.first[k], w.first[k + 1]
                words.append([flat[i:j] for i, j in zip(w.start[a:b].tolist(), w.end[a:b].tolist())])
                hashes.append(h[a:b])
        keep = [k for k in range(len(ids)) if words[k] and ids[k] is not None]
        self.ids = np.array([ids[k] for k in keep], dtype=np.int64)
        self.counts: list[Counter] = []
        shingles, sizes, by_size = [], [], {}
        for n, k in enumerate(keep):
            size = len(words[k])
            s = min(SHINGLE, size)
            self.counts.append(Counter(tuple(words[k][i:i + s]) for i in range(size - s + 1)))
            own = np.unique(shingle_hashes(hashes[k], s))
            shingles.append(own)
            sizes.append(np.full(len(own), size))
            by_size.setdefault(size, []).append((n, shingle_hashes(hashes[k], s)))
        flat = np.concatenate(shingles) if shingles else np.empty(0, np.uint64)
        of = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        order = np.lexsort((of, flat))
        flat, of = flat[order], of[order]
        fresh = np.ones(len(flat), dtype=bool)
        fresh[1:] = (flat[1:] != flat[:-1]) | (of[1:] != of[:-1])
        self.shingles, self.sizes = flat[fresh], of[fresh]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.shingles & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        self.by_size: dict[int, SizeIndex] = {}
        for size, members in by_size.items():
            prints = np.array([window_prints(h, np.array([0]), np.array([len(h)]))[0] for _, h in members])
            blocks = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BLOCKS)
            starts, lists = np.zeros((BLOCKS, 257), dtype=np.int64), []
            for b in range(BLOCKS):
                near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ blocks[None, :, b]) <= RADIUS // BLOCKS
                value, item = np.nonzero(near)
                starts[b, 1:] = np.cumsum(np.bincount(value, minlength=256))
                lists.append(item)
            self.by_size[size] = SizeIndex(size, min(SHINGLE, size), np.array([n for n, _ in members]), prints, starts, lists)
        self.shingle_sizes = sorted({x.shingle for x in self.by_size.values()})

    def windows(self, chunk: Chunk, words: Words, hashes: np.ndarray) -> dict[int, np.ndarray]:
        """Per item size, the first words of all windows that share a shingle with an item of the size.

        A window without one has similarity 0, so nothing is lost; all others get a fingerprint.
        """
        found: dict[int, np.ndarray] = {}
        for s in self.shingle_sizes:
            h = shingle_hashes(hashes, s)
            at = np.flatnonzero(self.filter[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            low, high = np.searchsorted(self.shingles, h[at], "left"), np.searchsorted(self.shingles, h[at], "right")
            within = words.doc[at] == words.doc[at + s - 1]
            n = np.where(within, high - low, 0)
            place = np.repeat(at, n)
            size = self.sizes[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
            for z in np.unique(size):
                if min(SHINGLE, z) == s:
                    hits = place[size == z]
                    # Windows stop at the document's edges; those of the hit before are there already.
                    first = np.maximum(hits - (z - s), words.first[words.doc[hits]])
                    first[1:] = np.maximum(first[1:], hits[:-1] + 1)
                    found[int(z)] = expand(first, hits + 1)
        return found

    def matches(self, chunk: Chunk) -> dict[int, list[tuple[int, float, int, int]]]:
        """Per document of the chunk: its best window for each item it contains, (item, similarity, place, words)."""
        low, words = _lower_chunk(chunk)
        hashes = hash_spans(low, words.start, words.end)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for z, starts in self.windows(chunk, words, hashes).items():
            index = self.by_size[z]
            width = z - index.shingle + 1
            all_shingles = shingle_hashes(hashes, index.shingle)
            for part in np.array_split(starts, max(1, len(starts) // 4096)):
                end = words.first[words.doc[part] + 1]
                prints = window_prints(all_shingles, part, np.minimum(part + width, end - index.shingle + 1))
                window, item = index.near(prints)
                for w, i in zip(window.tolist(), index.items[item].tolist()):
                    first = int(part[w])
                    stop = min(first + z, int(end[w]))
                    a, b = words.start[first:stop].tolist(), words.end[first:stop].tolist()
                    text = [low[x:y].tobytes() for x, y in zip(a, b)]
                    s = index.shingle
                    value = weighted_similarity(
                        Counter(tuple(text[k:k + s]) for k in range(len(text) - s + 1)), self.counts[i])
                    if value >= SIMILARITY:
                        doc = int(words.doc[first])
                        rank = (value, -(first - int(words.first[doc])), stop - first)
                        if rank > best.get((doc, i), (0.0, 0, 0)):
                            best[doc, i] = rank
        out: dict[int, list[tuple[int, float, int, int]]] = {}
        for (doc, i), (value, place, n) in best.items():
            out.setdefault(doc, []).append((int(self.ids[i]), value, -place, n))
        return out


def _index_blocks(benchmark: DataFrame) -> Iterator[BenchmarkIndex]:
    """The benchmark in blocks of about INDEX_BYTES, each small enough to be sent to every task."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // INDEX_BYTES))
    for k in range(n):
        rows = benchmark.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).select("item_id", "text").collect()
        yield BenchmarkIndex([r[0] for r in rows], [r[1] for r in rows])


def with_benchmark_matches(docs: DataFrame, benchmark: DataFrame, column: str = "benchmark_matches",
                           keep_text: bool = True) -> DataFrame:
    """Append an array of (item_id, similarity, first_word, n_words), one entry per item found in the text.

    Windows have as many words as an item (less where the document ends), lower-cased A-Z, and match at
    0.8 or more of the counts of five-word shingles; an item of fewer words is one shingle. The entry is the
    item's best window, the first of equals. Items without a word or an id match nothing, nor do null texts.
    Documents are handled alone, so hot sources, copies and repeated rows need no shuffle at all; equal items
    with two ids are both reported. A column of the given name is replaced.
    """
    sc = docs.sparkSession.sparkContext
    columns = [c for c in docs.columns if c != column and (keep_text or c != "text")]
    inner = docs.select(*columns, F.col("text").alias("_matched_text"))
    schema = inner.drop("_matched_text").schema.add(column, MATCHES)
    arrow_type = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()),
                                     ("first_word", pa.int64()), ("n_words", pa.int64())]))
    indexes = [sc.broadcast(i) for i in _index_blocks(benchmark)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for chunk in chunks(batch.column(batch.num_columns - 1)):
                for index in indexes:
                    for k, entries in index.value.matches(chunk).items():
                        found[chunk.first_row + k] += [
                            dict(zip(("item_id", "similarity", "first_word", "n_words"), e)) for e in entries]
            for f in found:
                f.sort(key=lambda e: e["item_id"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, type=arrow_type)], names=schema.names)

    return inner.mapInArrow(run, schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    found = with_benchmark_matches(docs.select("doc_id", "text"), benchmark, keep_text=False)
    return found.select("doc_id", F.inline("benchmark_matches"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item."""
    return with_benchmark_matches(docs, benchmark, "_benchmark_matches").where(
        F.size("_benchmark_matches") == 0).select(*docs.columns)
