"""Near copies: texts whose sets of five-word shingles are at least 0.8 alike, found by SimHash and an exact prefix join.

Every set has a 64-bit SimHash fingerprint. Covering masks bring all fingerprints within 3 bits together (`simhash.near_links`), and
these candidates are compared as sets first. A fingerprint may differ in more bits at 0.8, so an exact join follows for all
sets that are not joined by then.

All shingles have one order. Of two sets that share four fifths of the larger, each holds a shared shingle among its
first n - ceil(4n / 5) + 1, so every such pair meets under some shingle of these prefixes. The least key of a shingle's
texts is their pivot, and all that share a pivot are a group: a text has a few pivots where it has hundreds of
shingles. Groups are compared by size and parity where they lie, in tiles, so no list of all pairs is ever made; what is
left is compared as sets. The order changes the work and never the result: shingles seen often in a sample come last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from marram.llm.components import components
from marram.llm.decontaminate import SHINGLE, expand, shingle_hashes
from marram.llm.simhash import SEED, fingerprint_of, near_links, one_per_root
from marram.llm.tokens import LOWER, chunks, find_words, hash_spans
from marram.session import count_written, ensure_checkpoint_dir, in_few_tasks, kept, shared_root

# Texts looked at for frequent shingles: so many, or one in SAMPLE_SHARE of a large table; how many of them make one frequent;
# and how many frequent ones are sent to every task (8 bytes each).
ORDER_SAMPLE, SAMPLE_SHARE, OFTEN, MOST_OFTEN = 5000, 20, 4, 1 << 20
NARROWEST = 256  # bits of a parity, at least
# Keys that are broadcast (8 bytes each); more of them are joined by a shuffle.
FEW_KEYS = 100_000
# Bits of a filter of fixed size, in which shingles of several texts are marked before their texts are sent to them.
FILTER_BITS = 1 << 24
# A group is compared in tiles of two blocks, each of about so many texts and bytes of parity; words compared at once.
TILE, TILE_BYTES = 2048, 8 << 20
WORDS_AT_ONCE = 1 << 20
# Text hashed at once; the arrays for it take some hundred times the bytes.
HASHED_BYTES = 1 << 18


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Each text's different shingles as sorted hashes: five words in lower case (A-Z), all words of a shorter text."""
    for chunk in chunks(column, HASHED_BYTES):
        words = find_words(chunk)
        hashes = hash_spans(LOWER[chunk.buf], words.start, words.end)
        five = shingle_hashes(hashes, SHINGLE)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            yield np.unique(five[a:b - SHINGLE + 1] if b - a >= SHINGLE else shingle_hashes(hashes[a:b], b - a))


def set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED)


def _as_long(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def prefix(shingles: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n / 5) + 1 shingles, those of the sorted array `often` last."""
    n = len(shingles)
    size = n - -(-4 * n // 5) + 1 if n else 0
    if not len(often):
        return shingles[:size]
    late = often[np.minimum(np.searchsorted(often, shingles), len(often) - 1)] == shingles
    return np.concatenate([shingles[~late][:size], shingles[late][:max(0, size - int((~late).sum()))]])


def parity(shingles: np.ndarray) -> np.ndarray:
    """One bit for each share of all hashes: whether the set holds an odd number of it. At least two bits a shingle.

    Every differing bit takes a shingle that one set lacks, so sets differ in at least as many shingles as bits. Widths are
    powers of two, so a wide parity folded by XOR is the narrow one of the same set.
    """
    width = max(NARROWEST, 1 << (2 * max(1, len(shingles)) - 1).bit_length())
    odd = np.bincount((shingles % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _table(docs: DataFrame, often: np.ndarray, folder: str) -> DataFrame:
    """(o, x, n, mark, parity, prefix) for every row, written and read again. `mark` is the set's SimHash fingerprint.

    `x` stands for the row's set. A task gives the columns after it once for equal sets; elsewhere they are null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(often)
    keyed = docs.select(F.struct("doc_id", F.xxhash64(*docs.columns).alias("row")).alias("o"), "text")
    schema = StructType([
        StructField("o", keyed.schema["o"].dataType), StructField("x", LongType()), StructField("n", LongType()),
        StructField("mark", LongType()), StructField("parity", BinaryType()), StructField("prefix", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, sizes, marks, bits, prefixes = [], [], [], [], []
            for own in shingle_sets(batch.column(1)):
                keys.append(set_key(own))
                fresh = keys[-1] not in seen
                seen.add(keys[-1])
                sizes.append(len(own) if fresh else None)
                marks.append(_as_long(fingerprint_of(own)) if fresh else None)
                bits.append(parity(own).tobytes() if fresh else None)
                prefixes.append(prefix(own, shared.value).view(np.int64) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(sizes, type=pa.int64()),
                 pa.array(marks, type=pa.int64()), pa.array(bits, type=pa.binary()), pa.array(prefixes, type=pa.list_(pa.int64()))], names=schema.names)

    keyed.mapInArrow(run, schema).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def _sets(docs: DataFrame) -> DataFrame:
    """(x, shingles); a task gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for own in shingle_sets(batch.column(0)):
                x = set_key(own)
                if x not in seen:
                    seen.add(x)
                    ends = pa.array([0, len(own)], type=pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array([x], dtype=np.uint64).view(np.int64)),
                         pa.ListArray.from_arrays(ends, pa.array(own.view(np.int64)))], names=["x", "shingles"])

    return docs.select("text").mapInArrow(run, "x long, shingles array<long>")


def _often(docs: DataFrame, n_docs: int) -> np.ndarray:
    """The most frequent shingles of at least OFTEN texts of a sample that grows with the table."""
    share = min(1.0, max(ORDER_SAMPLE, n_docs / SAMPLE_SHARE) / max(1, n_docs))
    place = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    found = _sets(docs.where(place < share)).select(F.explode("shingles").alias("s")).groupBy("s").count()
    table = found.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "s").limit(MOST_OFTEN).select("s").toArrow()
    return np.sort(np.asarray(table.column("s").combine_chunks()).view(np.uint64))


def _few(keys: DataFrame) -> DataFrame:
    """Checkpointed keys, to be sent to the rows if they are few."""
    n = count_written(keys)
    return F.broadcast(keys) if n <= FEW_KEYS else in_few_tasks(keys, n)


def _sizes_allow(n1: int, n2: int) -> bool:
    return min(n1, n2) * 5 >= max(n1, n2) * 4


def _marked(table: DataFrame, shared: DataFrame) -> DataFrame:
    """(x, s) of the prefixes, without most shingles that are not among the `s` of `shared`: the filter lets some through."""
    cell = F.col("s").bitwiseAND(FILTER_BITS - 1)
    words = shared.select(F.shiftright(cell, 6).alias("word"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit")).groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    bits[np.asarray(words.column("word"))] = np.asarray(words.column("bits"))
    sent = table.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.asarray(batch.column(1).flatten())
            x = np.repeat(np.asarray(batch.column(0)), np.asarray(pc.list_value_length(batch.column(1))))
            cell = s.view(np.uint64) & np.uint64(FILTER_BITS - 1)
            keep = (sent.value[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)) > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(s[keep])], names=["x", "s"])

    return table.select("x", "prefix").mapInArrow(run, "x long, s long")


def _differ(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)


def _tile_pairs(rows: DataFrame) -> DataFrame:
    """(u, v) within the groups (p, one, two) of rows (x, n, root, block, parity) that size and parity allow to be 0.8 alike.

    Compared are rows with different roots, in a tile of two blocks those of different blocks. Groups arrive sorted, so a
    task holds one at a time.
    """
    group = ["p", "one", "two"]

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by("n")
        x, n, root, block = (np.asarray(table.column(c).combine_chunks()) for c in ("x", "n", "root", "block"))
        across = table.column("one")[0].as_py() != table.column("two")[0].as_py()
        bits = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in table.column("parity")]
        width = np.array([len(b) for b in bits])
        # Rows are sorted by size, so what size allows for a row is a run after it. Widths grow with sizes.
        upto = np.searchsorted(n, n * 5 // 4, side="right")
        for words in np.unique(width).tolist():
            first, last = np.searchsorted(width, [words, words + 1])
            end = int(upto[last - 1])
            same = np.stack([folded(b, words) for b in bits[first:end]])
            step = max(1, WORDS_AT_ONCE // (words * max(1, end - first)))
            for low in range(first, last, step):
                own = np.arange(low, min(low + step, last))
                a = np.repeat(own, upto[own] - own - 1)
                b = expand(own + 1, upto[own])
                keep = root[a] != root[b]
                if across:
                    keep &= block[a] != block[b]
                a, b = a[keep], b[keep]
                # At 0.8 or more the sets differ in at most a ninth of both their sizes.
                near = _differ(same[a - first], same[b - first]) * 9 <= n[a] + n[b]
                pair = np.sort(np.stack([x[a[near]], x[b[near]]], axis=1), axis=1)
                if len(pair):
                    yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(3)], axis=1)
            starts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            cuts = [0, *starts.tolist(), batch.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if high > low:
                    if held and tuple(c[0].as_py() for c in held[0].columns[:3]) != tuple(keys[low].tolist()):
                        yield from compared(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(low, high - low))
        if held:
            yield from compared(pa.Table.from_batches(held))

    laid = rows.select(*group, "x", "n", "root", "block", "parity").repartition(*group).sortWithinPartitions(*group)
    return laid.mapInArrow(run, "u long, v long").distinct()


def _with_payload(pairs: DataFrame, payload: DataFrame, sets: int) -> DataFrame:
    """(u, part, first, x, …): for every u of pairs (u, v) a first row of its own, then one row per v, with the payload of x.

    A crowded u is dealt out to parts, each with the first row, so a payload is sent once per pair and part. `sets` is how many
    sets there are, which bounds the different u.
    """
    crowds = in_few_tasks(pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts")), sets)
    many = _few(crowds.where("parts > 1").checkpoint())
    parts = F.coalesce("parts", F.lit(1))
    others = pairs.join(many, "u", "left").select(
        "u", F.pmod(F.xxhash64("v"), parts).cast("int").alias("part"), F.lit(False).alias("first"), F.col("v").alias("x"))
    firsts = crowds.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("first"),
                           F.col("u").alias("x"))
    return others.unionByName(firsts).join(payload, "x").select("u", "part", "first", "x", "n", "payload")


def _against_first(rows: DataFrame, load: Callable[[pa.Scalar], object], score: Callable) -> DataFrame:
    """(u, v, score) for rows laid out by `_with_payload`: each is scored against the first of its part; no score, no row.

    Only the first row's payload is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            found: list[tuple[int, int, float]] = []
            u, first, x, n = (batch.column(c).to_pylist() for c in ("u", "first", "x", "n"))
            for k, payload in enumerate(batch.column("payload")):
                if first[k]:
                    held = load(payload), n[k]
                elif _sizes_allow(held[1], n[k]):
                    told = score(held[0], load(payload), held[1] + n[k])
                    if told is not None:
                        found.append((u[k], x[k], told))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], type=t) for c, t in enumerate(
                (pa.int64(), pa.int64(), pa.float64()))], names=["u", "v", "score"])

    laid = rows.repartition("u", "part").sortWithinPartitions("u", "part", F.desc("first"))
    return laid.mapInArrow(run, "u long, v long, score double")


def _parity_score(one: np.ndarray, two: np.ndarray, n: int) -> float | None:
    """The share of differing bits, if the sets may be 0.8 alike: then they differ in at most a ninth of both sizes."""
    words = min(len(one), len(two))
    differ = int(np.bitwise_count(folded(one, words) ^ folded(two, words)).sum())
    return differ / n if differ * 9 <= n else None


def _set_score(one: np.ndarray, two: np.ndarray, n: int) -> float | None:
    """The shared share, if it is 0.8 of what either set holds."""
    same = len(np.intersect1d(one, two, assume_unique=True))
    return same / (n - same) if same * 9 >= n * 4 else None


def _alike(docs: DataFrame, points: DataFrame, roots: DataFrame, pairs: DataFrame, sets: int) -> DataFrame:
    """The (checkpointed) pairs (u, v) whose sets share at least 0.8 of what either holds, checked shingle by shingle.

    One text per set is sent to each pair or, by way of u, to each group of pairs.
    """
    keys = pairs.select(F.explode(F.array("u", "v")).alias("x")).distinct()
    owners = in_few_tasks(keys.join(points, "x").join(roots.select("x", "n"), "x"), sets).select(
        "x", "n", F.col("o.doc_id").alias("_owner"), F.col("o.row").alias("_row")).checkpoint()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("payload"), F.xxhash64(*docs.columns).alias("_own"))
    texts = rows.join(_few(owners), F.col("doc_id").eqNullSafe(F.col("_owner")) & (F.col("_own") == F.col("_row"))).select(
        "x", "n", "payload")
    load = lambda text: next(shingle_sets(pa.array([text.as_py()], type=pa.large_string())))
    return kept(_against_first(_with_payload(pairs, texts, sets), load, _set_score).select("u", "v").distinct())


def _rooted(rows: DataFrame, classes: DataFrame, sets: int) -> DataFrame:
    """The columns of every set, with its `root` by classes (node, root)."""
    joined = rows.join(classes.withColumnRenamed("node", "x"), "x", "left")
    return in_few_tasks(joined.withColumn("root", F.coalesce("root", "x")), sets).checkpoint()


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after links (u, v) between members of classes (node, root)."""
    return kept(components(classes.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links)))


def simhash_pairs(marks: DataFrame) -> DataFrame:
    """Candidates (u, v) among rows (x, mark): enough to join all sets whose fingerprints are within 3 bits.

    Sets of one fingerprint meet its least set, and least sets meet along the links of the covering masks: no list of all pairs.
    """
    least = marks.groupBy("mark").agg(F.min("x").alias("least")).checkpoint()
    equal = marks.join(least, "mark").where("x != least").select(F.col("least").alias("u"), F.col("x").alias("v"))
    of = lambda c, x: least.select(F.col("mark").alias(c), F.col("least").alias(x))
    links = near_links(least.select(F.col("mark").alias("x"))).withColumnsRenamed({"u": "one", "v": "two"})
    across = links.join(of("one", "u"), "one").join(of("two", "v"), "two").select("u", "v")
    return equal.union(across.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) that are not joined yet."""
    of = lambda c: roots.select(F.col("x").alias(c), F.col("root").alias(f"root_{c}"))
    return pairs.join(of("u"), "u").join(of("v"), "v").where("root_u != root_v").select(*pairs.columns)


def near_set_classes(docs: DataFrame, table: DataFrame, points: DataFrame) -> DataFrame:
    """(node, root) for every set key that is linked to another by chains of sets 0.8 alike.

    Sets that SimHash brings together are compared first. Every set is then compared with its pivots that it is not joined to, by
    parity, and with the nearest as a set: linear work, as the first step, and both join a large group of near copies. Other pivots
    it is not joined to yet follow. Then all that share a pivot and are not joined yet are compared, in tiles.
    """
    sets = count_written(points)
    points = in_few_tasks(points, sets)
    own = table.where("prefix is not null")
    marks = in_few_tasks(own.groupBy("x").agg(F.min("n").alias("n"), F.min("mark").alias("mark")), sets).checkpoint()
    pairs = kept(simhash_pairs(marks.select("x", "mark")))
    # A set of a large group has many links; its first one mostly joins it, and the others need no text then.
    first = in_few_tasks(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), sets).checkpoint()
    classes = kept(components(_alike(docs, points, marks, first, sets)))
    others = _apart(pairs.join(first, ["u", "v"], "left_anti"), _rooted(marks, classes, sets))
    classes = _joined(classes, _alike(docs, points, marks, kept(others), sets))
    found = own.select("x", F.explode("prefix").alias("s"))
    shared = kept(found.groupBy("s").agg(F.min("x").alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1").select("s", "p"))
    members = kept(_marked(own, shared).join(shared, "s").select("p", "x").distinct())
    keys = members.where("p != x").select(F.explode(F.array("p", "x")).alias("x")).distinct()
    keys = in_few_tasks(keys, sets).checkpoint()
    prints = own.select("x", "n", F.col("parity").alias("payload")).join(_few(keys), "x", "left_semi").dropDuplicates(["x"]).checkpoint()
    sized = prints.select("x", "n", F.octet_length("payload").alias("bytes"))
    roots = _rooted(sized, classes, sets)
    star = _apart(members.where("p != x").select(F.col("p").alias("u"), F.col("x").alias("v")), roots)
    bits = lambda payload: np.frombuffer(payload.as_buffer(), dtype=np.uint64)
    near = kept(_against_first(_with_payload(kept(star), prints, sets), bits, _parity_score))
    best = near.groupBy("v").agg(F.min(F.struct("score", "u")).alias("best")).select(F.col("best.u").alias("u"), "v")
    best = in_few_tasks(best, sets).checkpoint()
    classes = _joined(classes, _alike(docs, points, roots, best, sets))
    more = _apart(near.join(best, ["u", "v"], "left_anti"), _rooted(sized, classes, sets))
    classes = _joined(classes, _alike(docs, points, roots, kept(more.select("u", "v")), sets))
    roots = _rooted(sized, classes, sets)
    rooted = members.join(roots, "x")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("bytes") / TILE_BYTES)).cast("int")
    mixed = rooted.groupBy("p").agg(F.min("root").alias("a"), F.max("root").alias("b"), blocks.alias("blocks"))
    mixed = in_few_tasks(mixed.where("a != b").select("p", "blocks"), sets).checkpoint()
    # Its pivot has met every set of a group already.
    open_ = rooted.where("p != x").join(_few(mixed), "p")
    placed = open_.withColumn("block", F.pmod(F.xxhash64("x", "p"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "p", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "x", "n", "root", "block")
    rest = kept(_tile_pairs(tiles.join(prints.select("x", F.col("payload").alias("parity")), "x")))
    return _joined(classes, _alike(docs, points, roots, rest, sets))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The documents without near copies: the row with the least id of each class stays, whole.

    Texts are near copies if chains of texts lead from one to the other whose five-word shingles are 0.8 alike.
    Texts of fewer words are near copies if all their words are equal, and null, blank and empty texts are one class.
    Null ids sort first; of rows equal in every column one stays. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    table = _table(docs, _often(docs, docs.count()), f"{shared_root(spark)}/near-{uuid.uuid4().hex}")
    points = table.groupBy("x").agg(F.min("o").alias("o")).checkpoint()
    linked = near_set_classes(docs, table, points).withColumnRenamed("node", "x")
    return one_per_root(docs, points.join(linked, "x", "left").select("o", F.coalesce("root", "x").alias("root")))
