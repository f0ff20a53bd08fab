"""Exact repeats of 100 bytes and more, by enhanced suffix arrays over content-addressed pieces of the corpus.

A suffix array of a whole corpus is one sequential object. Here it is cut so that the pieces can be built
apart and together still see every repeat:

* Every window of `length` bytes has an anchor, the place in it whose 24-byte hash is least. It depends on
  the window's bytes alone, so equal windows have equal anchors, and windows with different anchor hashes
  need never meet. An anchor owns a run of neighbouring windows; their bytes are its context.
* Contexts equal as a whole are one class: all but the first lose every window. Nothing else is needed for
  anchors whose contexts are all equal, however many.
* The first contexts of the other classes are gathered by anchor hash, and a suffix array with its
  common-prefix interval tree is built over the windows of each piece.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.tokens import Chunk, chunks, mix
from marram.session import ensure_checkpoint_dir, shared_root

LENGTH = 100
ANCHOR = 24
PLACE_BITS = 24
# Long documents are scanned in overlapping parts of this many bytes, which bounds a task's memory.
PART_BYTES = 1 << 21
# Contexts whose windows are sorted together; and those of one anchor beyond which windows are split by content.
BATCH_CONTEXTS = 8192
HOT_CONTEXTS = 20_000
NO_ID = -(1 << 63)  # stands for a null id: first in order
# A context's place in one long: start (56 bits), settled (1), windows (7). The text under its id is a column of its own.
START_BIT, SETTLED_BIT = 8, 7


def rolling_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of `size` bytes, from runs of 1, 2, 4, ... bytes."""
    h, n = mix(buf.astype(np.uint64) + np.uint64(1)), 1
    while n * 2 <= size:
        h = _join(h[:-n], h[n:], n)
        n *= 2
    return h if n == size else _join(h[:len(buf) - size + 1], h[size - n:], size)


def _join(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15 + 2 * n) + b
    return x ^ (x >> np.uint64(29))


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    n, out = 1, h
    while n * 2 <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    return out if n == width else np.minimum(out[:len(h) - width + 1], out[width - n:])


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, number of windows, context hash) of every anchor, windows within one document only.

    Of equal hashes in a window the leftmost is the anchor: places break ties in the low bits.
    """
    empty = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
    if len(buf) < length:
        return empty
    place = np.uint64((1 << PLACE_BITS) - 1)
    grams = mix(rolling_hashes(buf, ANCHOR))
    least = _sliding_least((grams & ~place) | np.arange(len(grams), dtype=np.uint64), length - ANCHOR + 1)
    at = (least & place).astype(np.int64)
    starts = np.arange(len(at))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    whole = starts + length <= offsets[doc + 1]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(at)))
    good = whole[first]
    first, count = first[good], count[good]
    windows = rolling_hashes(buf, length)
    context = mix(windows[first] * np.uint64(3) + mix(windows[first + count - 1]) + (at[first] - first).astype(np.uint64)
                  + (count.astype(np.uint64) << np.uint64(32)))
    return grams[at[first]], first, count, context


def _parts(chunk: Chunk, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, rows, shift): the chunk itself, or overlapping parts of its one long document.

    Two parts share length - 1 bytes, so every window lies in exactly one. A context that spans a cut comes
    out as two, which changes its class but no window's anchor.
    """
    rows = np.arange(chunk.first_row, chunk.first_row + chunk.n_docs)
    if len(chunk.buf) <= 2 * PART_BYTES:
        yield chunk.buf, chunk.offsets, rows, 0
        return
    for low in range(0, len(chunk.buf), PART_BYTES):
        part = chunk.buf[low:low + PART_BYTES + length - 1]
        yield part, np.array([0, len(part)]), rows, low


def lcp_of(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix of neighbouring rows of bytes, no longer than either row's own size."""
    differ = rows[1:] != rows[:-1]
    at = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(at, np.minimum(sizes[1:], sizes[:-1]))


def maximal_repeats(suffix_rows: np.ndarray, sizes: np.ndarray, left: np.ndarray, least: int = LENGTH
                    ) -> Iterator[tuple[int, np.ndarray]]:
    """Maximal repeat groups (length, all occurrences) among the given suffixes.

    `suffix_rows` holds the first bytes of each suffix, `sizes` how many are real, `left` the byte before it
    (negative where unknown, unlike any other). The suffixes are sorted, neighbours' common prefixes found,
    and a stack scan walks the tree of common-prefix intervals. An interval is a maximal repeat if the bytes to the
    left of its occurrences differ; if they are all the same, the repeat is part of one that starts earlier.
    """
    order = np.argsort(suffix_rows.view(f"S{suffix_rows.shape[1]}")[:, 0], kind="stable")
    lcp = lcp_of(suffix_rows[order], sizes[order])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (lcp >= least).astype(np.int8), [0]])))
    before = left[order]
    # changes[k]: how often the left byte changes up to k, or is unknown; an interval without a change is not maximal.
    odd = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0) | (before[:-1] < 0))])
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if high - low == 1:
            if odd[high] > odd[low]:
                yield int(lcp[low]), order[low:high + 1]
            continue
        stack: list[tuple[int, int]] = []  # (common prefix, first suffix)
        for k, depth in enumerate([*lcp[low:high].tolist(), 0], start=low):
            first = k
            while stack and stack[-1][0] > depth:
                shared, first = stack.pop()
                if odd[k] > odd[first]:
                    yield shared, order[first:k + 1]
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, first))


def _marks_of(contexts: list[bytes], counts: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes to remove: contexts that lose some, and from where to where, relative to the first window."""
    width = length + int(counts.max()) - 1
    flat = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in contexts) + b"\0" * width, dtype=np.uint8)
    owner = np.repeat(np.arange(len(contexts)), counts)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    rows = np.lib.stride_tricks.sliding_window_view(flat, width)[owner * width + shift]
    real = (counts + length - 1)[owner] - shift
    rows[np.arange(width)[None, :] >= real[:, None]] = 0
    left = np.where(shift > 0, flat[np.maximum(owner * width + shift - 1, 0)].astype(np.int64), -1)
    rank = np.lexsort((start[owner] + shift, doc[owner]))
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    # A context has fewer windows than a window has bytes, so its removed runs overlap: one run per context.
    low, high = np.full(len(contexts), width), np.zeros(len(contexts), dtype=np.int64)
    for size, group in maximal_repeats(np.ascontiguousarray(rows), real, left, length):
        later = group[group != group[np.argmin(place[group])]]
        np.minimum.at(low, owner[later], shift[later])
        np.maximum.at(high, owner[later], shift[later] + size)
    hit = np.flatnonzero(high)
    return hit, low[hit], high[hit]


def _start(place: Column) -> Column:
    return F.shiftright(place, START_BIT)


def _windows(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << SETTLED_BIT) - 1))


def _settled(place: Column) -> Column:
    return place.bitwiseAND(F.lit(1 << SETTLED_BIT)) > 0


def _anchor_table(docs: DataFrame, length: int) -> DataFrame:
    """(h, c, doc, copy, place): anchor hash, context hash, document, and where the context's windows start.

    These rows are what is shuffled, a few for every hundred bytes of text, so they hold five numbers only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for chunk in chunks(batch.column(2), PART_BYTES):
                for buf, offsets, rows, shift in _parts(chunk, length):
                    h, first, n, c = anchors(buf, offsets, length)
                    doc = np.searchsorted(offsets, first, side="right") - 1
                    start = first - offsets[doc] + shift
                    who, copy = ids[rows[doc]], copies[rows[doc]]
                    # Equal contexts within the chunk are settled here: only the first goes on to be compared.
                    order = np.lexsort((start, copy, who, c, h))
                    settled = np.zeros(len(h), dtype=bool)
                    if len(h) > 1:
                        a, b = order[:-1], order[1:]
                        same = (h[a] == h[b]) & (c[a] == c[b])
                        settled[b[same]] = True
                        # Rows that are one document repeated do not count as earlier copies of each other.
                        head = order[np.maximum.accumulate(np.where(np.append(False, same), 0, np.arange(len(order))))]
                        settled[order] &= ~((who[order] == who[head]) & (copy[order] == copy[head]) & (start[order] == start[head]))
                    place = start << START_BIT | settled.astype(np.int64) << SETTLED_BIT | n
                    # Settled rows are dealt out one by one, so a hot anchor brings a row per chunk at most.
                    h = np.where(settled, mix(h + start.astype(np.uint64) * np.uint64(5) + who.astype(np.uint64)), h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(who), pa.array(copy), pa.array(place)],
                        names=["h", "c", "doc", "copy", "place"])

    return docs.select("_doc", "_copy", "text").mapInArrow(run, "h long, c long, doc long, copy long, place long")


def _contexts(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts, cut out of their texts."""
    per_doc = found.groupBy("doc", "copy").agg(F.collect_set(F.struct("h", "start", "n")).alias("wanted"))
    joined = texts.join(per_doc, (F.col("_doc") == F.col("doc")) & (F.col("_copy") == F.col("copy")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # repeated rows are cut once a task
        for batch in batches:
            for doc, copy, text, wanted in zip(*(batch.column(k) for k in range(1, 5))):
                if not wanted.is_valid or (at := (doc.as_py(), copy.as_py())) in seen:
                    continue
                seen.add(at)
                raw, w = memoryview(text.as_buffer()), wanted.values
                starts, ns = np.asarray(w.field("start")), np.asarray(w.field("n"))
                # Slices only: a document's contexts overlap little.
                pieces = [bytes(raw[s:s + n + length - 1]) for s, n in zip(starts.tolist(), ns.tolist())]
                k = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [w.field("h"), pa.array(np.full(k, doc.as_py())), pa.array(np.full(k, copy.as_py())), w.field("start"),
                     w.field("n"), pa.array(pieces, type=pa.binary())], names=["h", "doc", "copy", "start", "n", "bytes"])

    # The same columns and the same kind of join as for the final cut, so both share one shuffle of the texts.
    return joined.select("doc_id", "_doc", "_copy", F.col("text").cast("binary").alias("text"), "wanted").mapInArrow(
        run, "h long, doc long, copy long, start long, n long, bytes binary")


def _suffix_marks(contexts: DataFrame, length: int) -> DataFrame:
    """Marks (doc, copy, low, high) from suffix arrays over all contexts that share an anchor hash.

    A task takes whole anchors, some thousand contexts at a time.
    """
    rows = contexts.repartition("h").sortWithinPartitions("h", "doc", "copy", "start")

    def settle(table: pa.Table) -> pa.RecordBatch:
        # Rows that are one document repeated bring a place more than once; such rows lie side by side.
        places = np.stack([np.asarray(table.column(c).combine_chunks()) for c in ("h", "doc", "copy", "start")])
        table = table.filter(pa.array(np.append(True, (places[:, 1:] != places[:, :-1]).any(axis=0))))
        doc, copy, start, n = (np.asarray(table.column(c).combine_chunks()) for c in ("doc", "copy", "start", "n"))
        order = np.lexsort((start, copy, doc))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.append(0, (doc[order][1:] != doc[order][:-1]) | (copy[order][1:] != copy[order][:-1])))
        k, low, high = _marks_of(table.column("bytes").to_pylist(), n.astype(np.int64), rank, start, length)
        low, high = start[k] + low, start[k] + high
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[k], copy[k], low, high)], names=["doc", "copy", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BATCH_CONTEXTS:
                table = pa.Table.from_batches(held)
                h = np.asarray(table.column("h").combine_chunks())
                cut = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if cut:
                    yield settle(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                size = len(h) - cut
        if size:
            yield settle(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "doc long, copy long, low long, high long")


def _window_marks(contexts: DataFrame, length: int) -> DataFrame:
    """Marks for anchors with very many different contexts: windows are dealt out by their own 128-bit hash."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, doc, copy, start = [], [], [], [], []
            for d, c, s, n, raw in zip(*(batch.column(k).to_pylist() for k in range(1, 6))):
                for k in range(n):
                    x = xxhash.xxh3_128_intdigest(raw[k:k + length])
                    high.append((x >> 64) - (1 << 63))
                    low.append((x & (1 << 64) - 1) - (1 << 63))
                    doc.append(d)
                    copy.append(c)
                    start.append(s + k)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (high, low, doc, copy, start)],
                                             names=["w1", "w2", "doc", "copy", "low"])

    windows = contexts.mapInArrow(run, "w1 long, w2 long, doc long, copy long, low long")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc", "copy", "low")).alias("first"), F.count(F.lit(1)).alias("k"))
    later = windows.join(first.where("k > 1"), ["w1", "w2"]).where(F.struct("doc", "copy", "low") > F.col("first"))
    return later.select("doc", "copy", "low", (F.col("low") + length).alias("high"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the document's place in the order: `_doc` (its id) and `_copy` (0 where ids are unique).

    Where some id occurs with several texts, `_copy` is the text's hash, which orders them without a window.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("_doc"))
    hashed = rows.select("_doc", F.xxhash64("text").alias("_hash"))
    several = hashed.groupBy("_doc").agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).where("a != b")
    return rows.withColumn("_copy", F.lit(0).cast("long") if several.isEmpty() else F.xxhash64("text"))


def repeat_marks(keyed: DataFrame, length: int = LENGTH, hot: int = HOT_CONTEXTS) -> DataFrame:
    """(doc, copy, low, high): byte runs covered by a `length`-byte string that also starts earlier."""
    spark = keyed.sparkSession
    place = F.col("place")
    anchor = Window.partitionBy("h", _settled(place))
    order = Window.partitionBy("h", _settled(place), "c").orderBy("doc", "copy", _start(place))
    ranked = _anchor_table(keyed, length).repartition("h").withColumns({
        "least": F.min("c").over(anchor), "greatest": F.max("c").over(anchor), "rank": F.rank().over(order)})
    # Anchors seen once are gone after this. What stays is written, small and compressed, and read twice.
    later = _settled(place) | (F.col("rank") > 1)
    path = f"{shared_root(spark)}/repeats-{uuid.uuid4().hex}"
    ranked.where(later | (F.col("least") != F.col("greatest"))).select(
        F.when(~later, F.col("h")).alias("h"), "doc", "copy", "place").write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema("h long, doc long, copy long, place long").parquet(path).select(
        "h", "doc", "copy", _start(place).alias("start"), _windows(place).alias("n"))
    whole = kept.where("h is null").select(
        "doc", "copy", F.col("start").alias("low"), (F.col("start") + F.col("n") + (length - 1)).alias("high"))
    firsts = kept.where("h is not null")
    crowded = firsts.groupBy("h").count().where(F.col("count") > hot).select("h").checkpoint()
    contexts = _contexts(firsts, keyed, length)
    if crowded.isEmpty():
        return whole.union(_suffix_marks(contexts, length))
    return whole.union(_suffix_marks(contexts.join(crowded, "h", "left_anti"), length)).union(
        _window_marks(contexts.join(crowded, "h", "left_semi"), length))


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that are left) for every row.

    Null texts are empty. Documents come in the order of their ids, nulls first, then of a hash of the text;
    rows equal in both are the same document and not earlier copies of themselves. Texts shorter than
    `length` lose nothing. Other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    keyed = _keyed(docs)
    marks = repeat_marks(keyed, length, hot)
    per_doc = marks.groupBy("doc", "copy").agg(F.collect_list(F.struct("low", "high")).alias("marks"))
    joined = keyed.join(per_doc, (F.col("_doc") == F.col("doc")) & (F.col("_copy") == F.col("copy")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, spans, digests, kept = [], [], [], [], []
            for text, marks in zip(batch.column(1), batch.column(2)):
                raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                gone = np.zeros(len(raw) + 1, dtype=np.int32)
                if marks.is_valid:
                    np.add.at(gone, np.asarray(marks.values.field("low")), 1)
                    np.add.at(gone, np.asarray(marks.values.field("high")), -1)
                gone = np.cumsum(gone)[:-1] > 0
                left = raw[~gone].tobytes()
                n_bytes.append(len(raw))
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(gone & ~np.append(False, gone[:-1]))) if len(raw) else 0)
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, type=pa.int64()), pa.array(removed, type=pa.int64()),
                 pa.array(spans, type=pa.int64()), pa.array(digests, type=pa.string()), pa.array(kept, type=pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.select("doc_id", F.col("text").cast("binary").alias("text"), "marks").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeat_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    return without_repeats(docs, length).drop("kept")
