"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.components import components
from marram.llm.tokens import LOWER, chunks, find_words
from marram.session import ensure_checkpoint_dir

SEED = 42
BITS = 64
# Fingerprints of one bucket that are compared directly; fuller buckets are split by finer masks.
DIRECT = 512


def covering_masks(places: list[int], radius: int) -> list[int]:
    """Bit masks over `places` such that any `radius` places are all outside at least one mask.

    Place i gets a vector m(i) of radius + 1 bits, not zero; the mask of a vector v != 0 holds the places
    with <m(i), v> odd. The vectors of `radius` differing places span at most `radius` dimensions, so some
    v is orthogonal to all of them, and under its mask the two fingerprints are equal.
    """
    top = 1 << (radius + 1)
    vector = {p: k % (top - 1) + 1 for k, p in enumerate(places)}
    return [sum(1 << p for p in places if (vector[p] & v).bit_count() % 2) for v in range(1, top)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; no hashes: zero."""
    ones = np.zeros(BITS, dtype=np.int64)
    for low in range(0, len(hashes), 1 << 15):
        part = hashes[low:low + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """One 64-bit fingerprint per text: words in lower case (A-Z), shingles of `shingle` words, XXH64 seed 42."""
    out = np.zeros(len(column), dtype=np.uint64)
    for chunk in chunks(column):
        words = find_words(chunk)
        # All words joined by one space, so a shingle is one slice.
        length = words.end - words.start
        ends = np.cumsum(length + 1)
        joined = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
        shift = np.repeat(ends - 1 - length - words.start, length)
        source = np.arange(len(shift)) + np.repeat(words.start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        joined[source + shift] = LOWER[chunk.buf[source]]
        flat, starts, stops = joined.tobytes(), ends - 1 - length, ends - 1
        digest = xxhash.xxh64_intdigest
        for k in np.flatnonzero(words.count):
            low, high = words.first[k], words.first[k + 1]
            size = min(shingle, high - low)
            hashes = np.fromiter(
                (digest(flat[a:b], SEED) for a, b in zip(starts[low:high - size + 1].tolist(),
                                                         stops[low + size - 1:high].tolist())),
                dtype=np.uint64, count=high - low - size + 1)
            out[chunk.first_row + k] = fingerprint_of(hashes)
    return out


def with_fingerprint(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     shingle: int = 3) -> DataFrame:
    """The `keep` columns plus `fingerprint` (long, the 64 bits as they are). A null text: fingerprint 0."""
    inner = docs.select(*keep, F.col(text).alias("_fingerprint_text"))
    schema = inner.drop("_fingerprint_text").schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_fingerprint_text")
            values = pa.array(fingerprints(batch.column(at), shingle).view(np.int64))
            rest = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*rest, values], names=schema.names)

    return inner.mapInArrow(run, schema)


def _tree_within(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span each component of the graph 'at most `radius` bits apart'; fewer links than values."""
    left, right = [], []
    open_ = np.ones(len(values), dtype=bool)
    for root in range(len(values)):
        if not open_[root]:
            continue
        open_[root], queue = False, [root]
        while queue:
            k = queue.pop()
            rest = np.flatnonzero(open_)
            if not len(rest):
                break
            near = rest[np.bitwise_count(values[rest] ^ values[k]) <= radius]
            open_[near] = False
            left.extend([k] * len(near))
            right.extend(near.tolist())
            queue.extend(near.tolist())
    return values[left], values[right]


def _links_in_buckets(buckets: DataFrame, radius: int) -> DataFrame:
    """Links among the fingerprints of each bucket; buckets hold at most a set number of fingerprints."""
    grouped = buckets.groupBy("bucket", "mask_id").agg(F.collect_set("x").alias("xs")).where(F.size("xs") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = np.asarray(lists.flatten()).view(np.uint64)
            ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            size = np.diff(ends)
            two = ends[:-1][size == 2]
            a, b = flat[two], flat[two + 1]
            near = np.bitwise_count(a ^ b) <= radius
            us, vs = [a[near]], [b[near]]
            for k in np.flatnonzero(size > 2):
                u, v = _tree_within(flat[ends[k]:ends[k + 1]], radius)
                us.append(u)
                vs.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us).view(np.int64)), pa.array(np.concatenate(vs).view(np.int64))],
                names=["u", "v"])

    return grouped.select("xs").mapInArrow(run, "u long, v long")


def near_links(points: DataFrame, radius: int = 3, direct: int = DIRECT) -> DataFrame:
    """Links (u, v) between distinct fingerprints `x`, enough to join all that are within `radius` bits.

    Every pair within the radius meets in a bucket of some covering mask. Buckets of up to `direct`
    fingerprints are searched as they are and give a spanning forest, never all pairs. The fingerprints of a
    fuller bucket agree on the mask's bits and may differ on the rest only, so the rest is covered by masks
    of its own, and so on. After three levels at most 8 bits are free, and a bucket has at most 256
    fingerprints: none is ever too large, whatever the data.
    """
    spark = points.sparkSession
    found = None
    now = points.select(F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("mask_id"), "x")
    parents = {0: list(range(BITS))}
    for level in range(4):
        rows, children = [], {}
        for parent, places in parents.items():
            for mask in covering_masks(places, radius):
                children[len(rows)] = [p for p in places if not mask >> p & 1]
                rows.append((parent, len(rows), _signed(mask)))
        if level == 0:
            mask = F.explode(F.array(*[F.struct(F.lit(c).alias("child"), F.lit(m).cast("long").alias("mask")) for _, c, m in rows]))
            masked = now.select("x", "bucket", mask.alias("m")).select("x", "bucket", "m.child", "m.mask")
        else:
            masks = spark.createDataFrame(rows, "parent int, child int, mask long")
            masked = now.join(F.broadcast(masks), F.col("mask_id") == F.col("parent"))
        split = masked.select(
            F.xxhash64("child", "bucket", F.col("x").bitwiseAND(F.col("mask"))).alias("bucket"),
            F.col("child").alias("mask_id"), "x")
        counts = split.groupBy("bucket", "mask_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").checkpoint()
        small = split.join(counts.where(F.col("n") <= direct).drop("n"), ["bucket", "mask_id"])
        links = _links_in_buckets(small, radius)
        found = links if found is None else found.union(links)
        full = counts.where(F.col("n") > direct).drop("n")
        if max(len(c) for c in children.values()) <= 8 or full.isEmpty():
            if not full.isEmpty():
                found = found.union(_links_in_buckets(split.join(full, ["bucket", "mask_id"]), radius))
            break
        now, parents = split.join(full, ["bucket", "mask_id"]).select("bucket", "mask_id", "x"), children
    return found


def near_classes(points: DataFrame, radius: int = 3, direct: int = DIRECT) -> DataFrame:
    """(x, root) for each fingerprint of the column `x`: those linked by chains of at most `radius` bits share one."""
    distinct = points.select("x").distinct()
    found = components(near_links(distinct, radius, direct)).withColumnRenamed("node", "x")
    return distinct.join(found, "x", "left").select("x", F.coalesce("root", "x").alias("root"))


def simhash_classes(docs: DataFrame, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, class_root.

    component_id is the least doc_id of the component. Texts that are null, empty or blank have fingerprint
    zero and are linked like any other. Repeated rows and ids each keep their row. Rows without an id count in
    links but are never a component's id; a component of such rows alone has a null id. An empty table gives
    an empty result. Equal fingerprints are folded before any search, so copies cost nothing.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    marked = with_fingerprint(docs).withColumnRenamed("fingerprint", "x").checkpoint()
    points = marked.groupBy("x").agg(F.min("doc_id").alias("least")).checkpoint()
    classes = near_classes(points).join(points, "x")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return marked.join(named.select("x", "root", "component_id"), "x", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("x"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("root").alias("class_root"))


def one_of_each_class(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The documents without near copies: the row with the least id of each class stays, whole.

    Nulls sort first among ids, then the other columns decide; of rows equal in all columns one stays.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    order = F.struct("doc_id", F.xxhash64(*docs.columns).alias("row"))
    keyed = docs.select("text", order.alias("o"))
    marked = with_fingerprint(keyed, keep=("o",)).withColumnRenamed("fingerprint", "x").checkpoint()
    points = marked.groupBy("x").agg(F.min("o").alias("o")).checkpoint()
    return one_per_root(docs, near_classes(points, radius).join(points, "x"))


def one_per_root(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The row with the least `o` (doc_id and the hash of all columns) of each `root` of `classes`, whole."""
    stay = classes.groupBy("root").agg(F.min("o").alias("o"))
    stay = stay.select(F.col("o.doc_id").alias("_stay_id"), F.col("o.row").alias("_stay_row"))
    kept = docs.withColumn("_stay", F.xxhash64(*docs.columns)).join(
        stay, F.col("doc_id").eqNullSafe(F.col("_stay_id")) & (F.col("_stay") == F.col("_stay_row")), "left_semi")
    # Only rows equal in every column can be left more than once.
    return kept.drop("_stay").dropDuplicates()
