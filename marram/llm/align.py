"""Cross-tokenizer alignment: two token sequences over the same bytes, cut into groups where tokens of both end.

Cumulative byte ends of each sequence are keys of a dictionary to token numbers. The keys both have, sorted, slice
both id lists into groups, and a group links each of its tokens of one side to each of the other.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from marram.llm.decontaminate import expand
from marram.session import ensure_checkpoint_dir, shared_root

TOKENIZERS = "/opt/tokenizers"
LEFT_FILE, RIGHT_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Texts are taken together up to this many bytes: one table of different pairs each. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20
# Texts handed to a tokenizer at once.
TEXT_BYTES = 1 << 20
# Different segments that a task remembers from one block to the next.
SEGMENTS = 400_000
CUT = re.compile(r"(?<=[!-~\w])(?= )")
SAFE_END = re.compile(r"[!-~\w]\Z")
JOINED = 256
# Ids of a tokenizer, at most.
MOST_ENTRIES = 1 << 17


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes are themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level vocabulary read from a tokenizer file; control strings within a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = [self.tokenizer.id_to_token(k) for k in range(self.tokenizer.get_vocab_size())]
        self.entries = [bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space."""
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A piece vocabulary that puts a space before the text itself; unknown characters fall back to bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.entries = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in ((k, self.model.id_to_piece(k)) for k in range(size))]
        self.space = [self.model.piece_to_id("▁")]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which the model adds by itself but for an empty rest."""
        ids = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [i if len(t) > 1 else self.space for t, i in zip(texts, ids)]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteLevel | Pieces:
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def common_cuts(left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of either side lie before each byte offset where tokens of both sides end; given are their ends.

    A token without bytes ends where the one before it does; the dictionary keeps the last, so it stays in that group.
    """
    of_left = dict(zip(left, range(1, len(left) + 1)))
    of_right = dict(zip(right, range(1, len(right) + 1)))
    keys = sorted(of_left.keys() & of_right.keys())
    return list(map(of_left.__getitem__, keys)), list(map(of_right.__getitem__, keys))


def segments(text: str) -> list[str]:
    """Space and text, cut before spaces that follow a letter, a digit or a printable ASCII character.

    Neither tokenizer has a token or a split rule that reaches across such a place, so the tokens of the whole are those of the
    parts, one after the other, and both sides end there.
    """
    return CUT.split(" " + text)


class Lexicon:
    """The alignment of every different segment met: encoded once, grouped once."""

    def __init__(self, left: ByteLevel | Pieces, right: ByteLevel | Pieces):
        self.sides = (left, right)
        self.place: dict[str, int] = {}
        self.chars = 0
        self.names: list[str | None] = []  # None: a side's bytes are not the segment's
        self.counts: list[np.ndarray] = []  # rows of n_a, n_b, n_groups, n_links
        self.codes: list[np.ndarray] = []  # left id above right id, of all links of all segments

    def learn(self, new: Sequence[str]) -> None:
        """Encode and group segments. Those that end where a cut is safe are encoded in a few strings, the rest each by itself."""
        joined = [k for k, t in enumerate(new) if SAFE_END.search(t)]
        alone = sorted(set(range(len(new))).difference(joined))
        parts = [new[k] for k in joined]
        strings = ["".join(parts[k:k + JOINED]) for k in range(0, len(parts), JOINED)]
        if joined and not self._add(parts, strings):
            alone = range(len(new))
        for k in alone:
            if not self._add([new[k]], [new[k]]):
                self._put([new[k]], [None], np.zeros((1, 4), dtype=np.int64), np.empty(0, dtype=np.int64))

    def _put(self, parts: Sequence[str], names: Sequence[str | None], counts: np.ndarray, codes: np.ndarray) -> None:
        self.place.update(zip(parts, range(len(self.names), len(self.names) + len(parts))))
        self.chars += sum(map(len, parts))
        self.names += names
        self.counts.append(counts)
        self.codes.append(codes)

    def _add(self, parts: Sequence[str], texts: Sequence[str]) -> bool:
        """Group the tokens of the texts, which are the parts joined; False if a side's bytes are others."""
        raw = "".join(texts).encode()
        ids, ends = [], []
        for side in self.sides:
            own = [i for found in side.encode(texts) for i in found]
            tokens = list(map(side.entries.__getitem__, own))
            if b"".join(tokens) != raw:
                return False
            ids.append(np.array(own, dtype=np.int64))
            ends.append(list(accumulate(map(len, tokens))))
        cuts = [np.array(c) for c in common_cuts(*ends)]
        n_left, n_right = (np.diff(c, prepend=0) for c in cuts)
        # Every part ends at a cut.
        part_ends = np.cumsum([len(p.encode()) for p in parts])
        last = np.searchsorted(np.array(ends[0])[cuts[0] - 1], part_ends) + 1
        group = np.repeat(np.arange(len(n_left)), n_left)
        codes = np.repeat(ids[0], n_right[group]) << 32 | ids[1][expand((cuts[1] - n_right)[group], cuts[1][group])]
        upto = [np.concatenate([[0], c]) for c in (*cuts, np.arange(1, len(n_left) + 1), np.cumsum(n_left * n_right))]
        counts = np.stack([np.diff(u[last], prepend=0) for u in upto], axis=1)
        self._put(parts, self._told(ids, cuts, n_left, n_right, last), counts, codes)
        return True

    def _told(self, ids: list[np.ndarray], cuts: list[np.ndarray], n_left: np.ndarray, n_right: np.ndarray,
              last: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each part, cut from the one of all parts."""
        out = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
        places = (np.arange(len(ids[0])) + np.repeat(cuts[1] - n_right, n_left),
                  np.arange(len(ids[1])) + np.repeat(cuts[0], n_right))
        for own, place, cut, sign in zip(ids, places, cuts, "|;"):
            told = decimals(sign)[0][own]
            told[cut - 1] = decimals(sign)[1][own[cut - 1]]
            out[place] = told
        pieces = out.tolist()
        upto = np.concatenate([[0], np.cumsum(list(map(len, pieces)))])[(cuts[0] + cuts[1])[last - 1]].tolist()
        whole = "".join(pieces)
        return [whole[a:b - 1] for a, b in zip([0, *upto[:-1]], upto)]


@lru_cache(maxsize=2)
def decimals(sign: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in decimal, followed by a comma, and by the sign that ends a side of a group."""
    return tuple(np.array([f"{k}{after}" for k in range(MOST_ENTRIES)], dtype=object) for after in (",", sign))


class Block:
    """Texts aligned one after the other, and the table of their different pairs."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.bytes = 0
        self.keys: list[pa.Array] = []
        self.parts: list[np.ndarray] = []  # each document's segments, by their numbers in the lexicon
        self.digests: list[str] = []

    def add(self, keys: pa.Array, texts: list[str | None], size: int) -> None:
        self.bytes += size
        self.keys.append(keys)
        cut = [segments(t) if t else [] for t in texts]
        known = self.lexicon.place
        self.lexicon.learn(list(dict.fromkeys(p for c in cut for p in c if p not in known)))
        for c in cut:
            numbers = list(map(known.__getitem__, c))
            names = list(map(self.lexicon.names.__getitem__, numbers))
            whole = bool(names) and None not in names
            self.parts.append(np.array(numbers if whole else [], dtype=np.int64))
            self.digests.append(hashlib.sha256(";".join(names).encode()).hexdigest() if whole else "")

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The documents, some at a time, then the block's own row."""
        counts = np.concatenate([np.empty((0, 4), dtype=np.int64), *self.lexicon.counts])
        ends = np.concatenate([[0], np.cumsum(counts[:, 3])])
        table, number = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *self.lexicon.codes]), return_inverse=True)
        pairs, times = [], []
        for part in self.parts:
            segment, n = np.unique(part, return_counts=True)
            low, high = ends[segment], ends[segment + 1]
            own, which = np.unique(number[expand(low, high)], return_inverse=True)
            pairs.append(own)
            times.append(np.bincount(which, np.repeat(n, high - low), minlength=len(own)).astype(np.int32))
        held = np.bincount(np.concatenate(pairs), minlength=len(table)) if pairs else np.zeros(len(table), dtype=np.int64)
        kept = np.cumsum(held > 0) - 1  # pairs of segments that only other blocks have are left out
        keys, ints = pa.concat_arrays(self.keys), pa.list_(pa.int32())
        for low, high in _runs([1 + 8 * len(p) for p in pairs], TEXT_BYTES):
            n = high - low
            sums = np.array([counts[p].sum(axis=0) for p in self.parts[low:high]])
            offsets = pa.array(np.cumsum([0, *map(len, pairs[low:high])]).astype(np.int32))
            lists = (kept[np.concatenate(pairs[low:high])], np.concatenate(times[low:high]))
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * n), keys.slice(low, n), *[pa.array(sums[:, k]) for k in range(4)],
                pa.array(self.digests[low:high]), *[pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in lists],
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, ints)], names=BLOCK_COLUMNS)
        yield pa.RecordBatch.from_arrays([
            pa.array([block]), pa.nulls(1, keys.type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()),
            *[pa.nulls(1, ints)] * 2, pa.array([table[held > 0]]), pa.array([held[held > 0].astype(np.int32)])], names=BLOCK_COLUMNS)


BLOCK_COLUMNS = ["block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "times", "pairs", "held"]


def _runs(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Cuts rows into runs of at most `most` together; a larger row is a run of its own."""
    low, total = 0, 0
    for k, size in enumerate(sizes):
        if k > low and total + size > most:
            yield low, k
            low, total = k, 0
        total += size
    if len(sizes) > low:
        yield low, len(sizes)


def _write_blocks(docs: DataFrame, paths: tuple[str, str], block_bytes: int, folder: str) -> DataFrame:
    """Texts of (key, text) aligned once, in blocks, written and read again.

    A document's row holds its counts, the numbers of its pairs in the block's table (`numbers`), and how often each is
    linked (`times`). A block's row holds that table (`pairs`, left id above right id) and how many of its documents have each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [tokenizer(p) for p in paths]
        number = TaskContext.get().partitionId() << 32
        lexicon = Lexicon(*sides)
        now = Block(lexicon)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for low, high in _runs(sizes, TEXT_BYTES):
                now.add(batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low).to_pylist(),
                        sum(sizes[low:high]))
                if now.bytes >= block_bytes:
                    yield from now.rows(number)
                    if len(lexicon.names) > SEGMENTS or lexicon.chars > block_bytes:
                        lexicon = Lexicon(*sides)
                    now, number = Block(lexicon), number + 1
        if now.keys:
            yield from now.rows(number)

    schema = StructType().add("block", "long").add("key", docs.schema["key"].dataType)
    for name in BLOCK_COLUMNS[2:6]:
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("numbers", ArrayType(IntegerType())).add("times", ArrayType(IntegerType()))
    schema = schema.add("pairs", ArrayType(LongType())).add("held", ArrayType(IntegerType()))
    docs.mapInArrow(run, schema).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold each linked pair, and whether no pair of its left id is in more."""
    tables = blocks.where("key is null").select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    counts = tables.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n"))
    # At most as many rows as the right vocabulary has entries share a left id.
    same = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same))


def token_alignment(docs: DataFrame, left: str = f"{TOKENIZERS}/{LEFT_FILE}", right: str = f"{TOKENIZERS}/{RIGHT_FILE}",
                    block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). Documents: the columns without `text` in a struct `key`, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256. Pairs: (left_id, right_id, n, best), the corpus-wide lexicon of linked ids.

    Texts are encoded whole, each different segment once a task. Pair counts are summed over blocks of texts, each with a table of its different pairs,
    so what is shuffled grows with those and not with the tokens; counts come back to the block, and a document's sums
    are taken from its numbers in that table. Null and empty texts, and those whose bytes a tokenizer changes, have zeros.
    Repeated rows are documents of their own. An empty table gives empty results.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    kept = [c for c in docs.columns if c != "text"]
    folder = f"{shared_root(spark)}/align-{uuid.uuid4().hex}"
    blocks = _write_blocks(docs.select(F.struct(*kept).alias("key"), "text"), (left, right), block_bytes, folder)
    counts = pair_counts(blocks)
    tables = blocks.where("key is null").select(F.col("block").alias("home"), F.posexplode("pairs").alias("number", "pair"))
    known = tables.join(counts, "pair").select("home", "number", "n", "best")
    documents = blocks.where("key is not null").drop("pairs", "held")
    schema = documents.drop("block", "numbers", "times").schema.add("n_best", "long").add("count_sum", "long")

    def fill(rows: pa.Table, table: pa.Table) -> pa.Table:
        n, best = np.zeros((2, table.num_rows), dtype=np.int64)
        place, count, highest = (np.asarray(table.column(c).combine_chunks().cast(pa.int64())) for c in ("number", "n", "best"))
        n[place], best[place] = count, highest
        lists = [rows.column(c).combine_chunks() for c in ("numbers", "times")]
        number, times = (np.asarray(v.flatten()).astype(np.int64) for v in lists)
        ends = np.cumsum([0, *pc.list_value_length(lists[0]).to_pylist()])
        out = rows.drop_columns(["block", "numbers", "times"])
        for name, value in (("n_best", best), ("count_sum", n)):
            running = np.concatenate([[0], np.cumsum(value[number] * times)])
            out = out.append_column(name, pa.array(np.diff(running[ends])))
        return out

    filled = documents.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(fill, schema)
    return filled, counts.select(F.shiftright("pair", 32).alias("left_id"),
                                 F.col("pair").bitwiseAND((1 << 32) - 1).alias("right_id"), "n", "best")


def alignment_report(docs: DataFrame, **settings: object) -> DataFrame:
    documents, _ = token_alignment(docs.select("doc_id", "text"), **settings)
    return documents.select("key.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
