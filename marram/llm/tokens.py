"""What the operators of this folder share: the word rule, null-safe ids, and numpy views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"

IS_GAP = np.zeros(256, dtype=bool)
IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
# A word of letters and digits: after lower-casing A-Z, a run of anything but the other ASCII characters.
MARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
IS_MARK = np.zeros(256, dtype=bool)
IS_MARK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Text handed to numpy at once. Larger documents are still taken whole, one at a time.
CHUNK_BYTES = 1 << 20

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_checksum(doc_id: Column) -> Column:
    """crc32 of the id as text, unsigned; null for a null id."""
    return F.crc32(doc_id.cast("string"))


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: remainder 1 by 3. A null id counts as not held out."""
    return F.coalesce(id_checksum(doc_id) % 3 == 1, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Some whole documents as one byte buffer; `offsets[k]:offsets[k + 1]` is document k."""

    first_row: int
    buf: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut an Arrow text column into runs of whole documents, without copying the text."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary())
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    valid = np.asarray(column.is_valid())
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + max_bytes, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Chunk(low, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], valid[low:high])
        low = high


@dataclass
class Words:
    """Places of all words of a chunk, in order."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    count: np.ndarray  # per document
    first: np.ndarray  # index of each document's first word, one more entry at the end


def find_words(chunk: Chunk, gaps: np.ndarray = IS_GAP) -> Words:
    inside = ~gaps[chunk.buf]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = chunk.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = chunk.doc_of(start)
    count = np.bincount(doc, minlength=chunk.n_docs) if len(doc) else np.zeros(chunk.n_docs, dtype=np.int64)
    return Words(start, end, doc, count, np.concatenate([[0], np.cumsum(count)]))


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per byte span (spans ascending, apart from each other, none empty)."""
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    length = end - start
    firsts = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(firsts, length)
    powers = np.ones(int(length.max()), dtype=np.uint64)
    powers[1:] = MULTIPLIER
    np.multiply.accumulate(powers, out=powers)
    bytes_ = buf[place + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(bytes_ * powers[place], firsts) + length.astype(np.uint64))


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """At most `limit` rows, always the same ones: those whose keys come first in a hashed order."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(limit)


SYMBOLS = "#*$%&|<>"


def with_counts(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The columns plus `_words`, `_symbols` and `_bytes` (long) of a text column; a null text counts as empty.

    Column expressions: texts never leave the JVM, and what is not asked for is not counted.
    """
    told = F.coalesce(F.col(text), F.lit(""))
    symbols = F.length(told) - F.length(F.translate(told, SYMBOLS, ""))
    counted = docs.withColumns({"_words": n_words(told), "_symbols": symbols.cast("long"), "_bytes": F.octet_length(told).cast("long")})
    return counted if keep_text else counted.drop(text)
