"""Forests grown tree by tree inside tasks, and judged there: neither trees nor votes pass through the driver.

The library grows a forest level by level and keeps it, with class counts of every node, on the driver. That is many times the
table where trees are not limited in depth. A table that one task can hold is sent to the tasks once, coded by the ranks of its
values, and serves all fits of a search or a curve: a task grows its trees one after another, adds up what they say on the rows to be
judged, and drops them. Larger tables are left to the library (`fits_in_tasks`).

Trees follow the library's rules: Gini impurity, Poisson(1) bags, ceil(sqrt(features)) features drawn per node, up to 32 equally filled bins per
feature, no cut without a gain, least leaves counted in rows of the bag. Bins are counted over all rows that a forest learns from, not over a sample.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.hashing import poisson_steps
from marram.operators.trees import Rule

# Numbers of a table that is sent to every task: 64 MB as doubles.
CELLS_IN_TASK = 1 << 23
BINS = 32  # the library's default
# Numbers, and counts by bin and class, that are looked at together when cuts are sought: as many as the processor's cache takes.
PLACES_TOGETHER = 1 << 14
COUNTS_TOGETHER = 1 << 16
# Nodes of at least so many rows a count are counted by bin and class, smaller ones are sorted.
DENSE = 1 / 4
# Trees that one task grows, and judged rows whose votes are added up together.
TREES_PER_TASK = 25
ROWS_PER_TALLY = 4096
POISSON_EDGES = np.array(poisson_steps())


@dataclass
class CodedRows:
    """Rows in their table's order. A code is the rank of a value among its feature's values."""

    codes: np.ndarray  # (rows, features)
    values: list[np.ndarray]  # per feature, ascending
    label: np.ndarray
    classes: int
    more: Mapping[str, np.ndarray] = field(default_factory=dict)


@dataclass
class BinnedRows:
    """The same rows for one fit: a code is the number of thresholds that a value passes."""

    codes: np.ndarray  # (rows, features)
    thresholds: list[np.ndarray]
    label: np.ndarray
    classes: int


@dataclass
class Fit:
    """One forest: the rows it learns from, the rows it is judged on, and the settings that are read off it."""

    train: np.ndarray  # bool per row
    judged: np.ndarray  # bool per row
    rules: Sequence[Rule]
    leaf: int = 1


@dataclass
class Tree:
    """Nodes level by level; children of a node lie side by side, a leaf has none (-1)."""

    left: np.ndarray
    feature: np.ndarray
    code: np.ndarray  # the largest one that goes left
    threshold: np.ndarray
    counts: np.ndarray  # (nodes, classes): rows of the bag
    gain: np.ndarray
    levels: list[int]  # first node of each level, and the number of nodes


def fits_in_tasks(df: DataFrame) -> bool:
    """Whether a table of `features` is small enough to be held by every task."""
    first = df.select(F.size(vector_to_array("features")).alias("n")).first()
    return first is not None and df.count() * first.n <= CELLS_IN_TASK


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def coded_rows(df: DataFrame, classes: int | None = None, **more) -> CodedRows:
    """The table (label, features) and further columns of numbers or of arrays of numbers, fetched in its own order."""
    named = df.schema["label"].metadata.get("ml_attr", {}).get("num_vals")
    table = df.select("label", vector_to_array("features").alias("x"), *[c.alias(n) for n, c in more.items()]).toArrow()
    label = np.asarray(table.column("label").combine_chunks()).astype(np.int64)
    x = _matrix(table, "x")
    table = table.drop_columns("x")
    values, codes = [], np.empty(x.shape, dtype=np.uint16 if len(x) <= 1 << 16 else np.uint32)
    for f in range(x.shape[1]):
        distinct, codes[:, f] = np.unique(x[:, f], return_inverse=True)
        values.append(distinct)
    nested = {n: pa.types.is_list(table.schema.field(n).type) for n in more}
    kept = {n: (_matrix(table, n) if nested[n] else np.asarray(table.column(n).combine_chunks())).copy() for n in more}
    del table, x
    pa.default_memory_pool().release_unused()
    return CodedRows(codes, values, label, classes or named or int(label.max(initial=0)) + 1, kept)


def _feature_sets(rng: np.random.Generator, nodes: int, features: int, wanted: int) -> np.ndarray:
    """`wanted` different features for each node, in random order."""
    deck = np.tile(np.arange(features, dtype=np.int32), (nodes, 1))
    row = np.arange(nodes)
    for k in range(wanted):
        drawn = rng.integers(k, features, nodes)
        deck[row, k], deck[row, drawn] = deck[row, drawn], deck[row, k].copy()
    return deck[:, :wanted]


def _bits(most: int) -> int:
    return max(1, int(most).bit_length())


def binned(rows: CodedRows, at: np.ndarray) -> BinnedRows:
    """All rows in the bins of the rows `at`. Few values have a threshold between any two, more have `BINS` - 1 at most."""
    codes, thresholds = np.empty(rows.codes.shape, dtype=np.uint8), []
    for f, values in enumerate(rows.values):
        n = np.bincount(rows.codes[at, f], minlength=len(values))
        seen = np.flatnonzero(n)
        if len(seen) > BINS:
            upto = np.cumsum(n[seen])
            wanted = upto[-1] * np.arange(1, BINS) / BINS
            after = np.clip(np.searchsorted(upto, wanted), 1, len(seen) - 1)
            edge = np.unique(np.where(wanted - upto[after - 1] < upto[after] - wanted, after - 1, after))
            edge = edge[edge < len(seen) - 1]
        else:
            edge = np.arange(len(seen) - 1)
        low, high = values[seen[edge]], values[seen[edge + 1]]
        with np.errstate(invalid="ignore", over="ignore"):
            middle = low + (high - low) / 2
        thresholds.append(np.where((middle >= low) & (middle < high), middle, low))
        codes[:, f] = np.searchsorted(thresholds[-1], values).astype(np.uint8)[rows.codes[:, f]]
    return BinnedRows(codes, thresholds, rows.label, rows.classes)


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbours taken together up to about `most`."""
    part = (np.cumsum(sizes) - 1) // most
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _best_cuts(rows: BinnedRows, at: np.ndarray, weight: np.ndarray, node: np.ndarray, counts: np.ndarray,
               feats: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """(nodes that are cut, feature, code, gain) of the open nodes of a level; rows lie by node."""
    size, wanted, cells = np.bincount(node, minlength=len(counts)), feats.shape[1], BINS * rows.classes
    total, squares = counts.sum(axis=1), (counts * counts).sum(axis=1)
    best, feature, code = np.full(len(counts), -1.0), np.full(len(counts), -1), np.full(len(counts), -1)
    dense = size >= cells * DENSE
    for nodes, look, costs, most in ((np.flatnonzero(dense), _by_counts, np.full(int(dense.sum()), cells), COUNTS_TOGETHER),
                                     (np.flatnonzero(~dense), _by_order, size[~dense] * wanted, PLACES_TOGETHER)):
        if not len(nodes):
            continue
        mine = dense[node] == (look is _by_counts)
        at_, weight_, size_ = at[mine], weight[mine], size[nodes]
        end = np.cumsum(size_)
        for a, b in _parts(costs, most):
            own, these = slice(end[a] - size_[a], end[b - 1]), nodes[a:b]
            best[these], feature[these], code[these] = look(
                rows, at_[own], weight_[own], size_[a:b], counts[these], total[these], squares[these], feats[these], leaf)
    least = squares / total
    cut = best > least * (1 + 1e-12)
    return cut, feature[cut], code[cut], (best - least)[cut] / total[cut]


def _by_counts(rows: BinnedRows, at: np.ndarray, weight: np.ndarray, size: np.ndarray, counts: np.ndarray, total: np.ndarray,
               squares: np.ndarray, feats: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """(score, feature, code) of the best cut of each node, from its rows by feature, bin and class."""
    shape = (len(size), BINS, rows.classes)
    node, every = np.repeat(np.arange(len(size)), size), np.arange(len(size))
    base, place, codes = node * (BINS * rows.classes) + rows.label[at], at * rows.codes.shape[1], rows.codes.ravel()
    weight, counts = weight.astype(float), counts.astype(float)
    best, feature, code = np.full(len(size), -1.0), np.full(len(size), -1), np.full(len(size), -1)
    for drawn in feats.T:
        cell = codes.take(place + drawn[node]).astype(np.int64)
        cell *= rows.classes
        cell += base
        left = np.bincount(cell, weights=weight, minlength=math.prod(shape)).reshape(shape)
        for k in range(1, BINS):
            left[:, k] += left[:, k - 1]
        n_left, left_squares = left.sum(axis=2), np.einsum("nbc,nbc->nb", left, left)
        n_right = total[:, None] - n_left
        right_squares = squares[:, None] - 2 * np.einsum("nbc,nc->nb", left, counts) + left_squares
        score = left_squares / np.maximum(n_left, 1) + right_squares / np.maximum(n_right, 1)
        score *= (n_left >= leaf) & (n_right >= leaf)
        found = score.argmax(axis=1)
        score = score[every, found]
        better = score > best
        best[better], feature[better], code[better] = score[better], drawn[better], found[better]
    return best, feature, code


def _by_order(rows: BinnedRows, at: np.ndarray, weight: np.ndarray, size: np.ndarray, counts: np.ndarray, total: np.ndarray,
              squares: np.ndarray, feats: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """The same for small nodes. Every (node, feature) pair is a run of sorted codes.

    The sums of squared class counts on both sides of a cut change by the class counts passed so far when a row goes from right to
    left, so one running sum per side does for all classes.
    """
    (n_open, wanted), classes, length = feats.shape, rows.classes, len(at) * feats.shape[1]
    code_bits, class_bits, weight_bits, place_bits = _bits(BINS - 1), _bits(classes - 1), _bits(weight.max()), _bits(length)
    most = max(_bits(n_open * wanted) + code_bits + class_bits + weight_bits, _bits(n_open * wanted * classes) + place_bits)
    kind = np.int32 if most < 32 and int(total.max()) ** 2 < 1 << 31 else np.int64
    node = np.repeat(np.arange(n_open, dtype=kind), size)
    key = node[:, None] * kind(wanted) + np.arange(wanted, dtype=kind)
    key <<= code_bits
    key |= rows.codes.ravel().take((at * rows.codes.shape[1])[:, None] + feats[node])
    key <<= class_bits + weight_bits
    key |= (rows.label[at] << weight_bits | weight).astype(kind)[:, None]
    key = key.ravel()
    key.sort()

    run_size = np.repeat(size, wanted)
    last = np.cumsum(run_size) - 1
    w = key & kind((1 << weight_bits) - 1)
    key >>= weight_bits
    c = key & kind((1 << class_bits) - 1)
    key >>= class_bits
    owner = np.repeat(np.arange(n_open, dtype=kind), size * wanted)

    # Rows of the same class before each row of a run.
    by_class = key >> code_bits
    by_class *= classes
    by_class += c
    by_class <<= place_bits
    by_class |= np.arange(length, dtype=kind)
    by_class.sort()
    there = by_class & kind((1 << place_bits) - 1)
    by_class >>= place_bits
    starts = np.flatnonzero(by_class[1:] != by_class[:-1])
    starts = np.concatenate([[0], starts + 1])
    ws = w.take(there)
    passed = np.cumsum(ws, dtype=kind)
    passed -= ws
    passed -= np.repeat(passed[starts], np.diff(starts, append=length))
    before = np.empty(length, dtype=kind)
    before[there] = passed

    # Running sums over all runs; what a run starts from is taken off. Sums over many runs may wrap round, differences are right.
    c += owner * kind(classes)
    cross = counts.astype(kind).ravel().take(c)
    cross *= w
    before *= 2
    before += w
    before *= w
    n_left, left, cross = (np.cumsum(each, dtype=kind) for each in (w, before, cross))
    for sums in (n_left, left, cross):
        start = np.zeros(len(last), dtype=kind)
        start[1:] = sums[last[:-1]]
        sums -= np.repeat(start, run_size)
    n_right = total.astype(kind).take(owner)
    n_right -= n_left
    may = np.empty(length, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=may[:-1])
    may[last] = False
    if leaf > 1:
        may &= (n_left >= leaf) & (n_right >= leaf)
    right = squares.astype(kind).take(owner)
    right += left
    cross *= 2
    right -= cross
    n_right[last] = 1
    score = left / n_left
    score += right / n_right
    score *= may

    best = np.maximum.reduceat(score, (last - run_size + 1)[::wanted])
    hit = np.flatnonzero(score == best.take(owner))
    own = owner[hit]
    first = np.diff(own, prepend=-1) > 0
    hit, own = hit[first], own[first]
    return best, feats[own, (key[hit] >> code_bits) - own * wanted], key[hit] & ((1 << code_bits) - 1)


def grow(rows: BinnedRows, at: np.ndarray, weight: np.ndarray, rng: np.random.Generator, *, depth: int, leaf: int = 1,
         split: int = 2) -> Tree:
    """One tree from the rows `at`, drawn `weight` times each. Nodes of fewer than `split` rows of the bag are not cut."""
    features, classes = rows.codes.shape[1], rows.classes
    wanted = math.ceil(math.sqrt(features))
    drawn = weight > 0
    at, weight = at[drawn], weight[drawn].astype(np.int64)
    node = np.zeros(len(at), dtype=np.int64)
    counts = np.bincount(rows.label[at], weights=weight, minlength=classes).astype(np.int64)[None, :]
    nodes, levels = [], [0, 1]
    for level in range(depth + 1):
        total = counts.sum(axis=1)
        left, feature, code, gain = (np.full(len(counts), v) for v in (-1, -1, -1, -1.0))
        nodes.append((left, feature, code, gain, counts))
        is_open = (counts.max(axis=1) < total) & (total >= max(split, 2 * leaf)) & (level < depth)
        if not is_open.any():
            break
        stays = is_open[node]
        at, weight, node = at[stays], weight[stays], (np.cumsum(is_open) - 1)[node[stays]]
        feats = _feature_sets(rng, int(is_open.sum()), features, wanted)
        cut, found, upto, won = _best_cuts(rows, at, weight, node, counts[is_open], feats, leaf)
        where = np.flatnonzero(is_open)[cut]
        if not len(where):
            break
        left[where] = levels[-1] + 2 * np.arange(len(where))
        feature[where], code[where], gain[where] = found, upto, won
        stays = cut[node]
        at, weight, node = at[stays], weight[stays], (np.cumsum(cut) - 1)[node[stays]]
        node = 2 * node + (rows.codes[at, found[node]] > upto[node])
        # Rows lie by node again.
        place_bits = _bits(len(at))
        order = node << place_bits | np.arange(len(at))
        order.sort()
        order &= (1 << place_bits) - 1
        at, weight, node = at[order], weight[order], node[order]
        counts = np.bincount(node * classes + rows.label[at], weights=weight, minlength=2 * len(where) * classes)
        counts = counts.astype(np.int64).reshape(-1, classes)
        levels.append(levels[-1] + len(counts))
    left, feature, code, gain, counts = (np.concatenate(p) for p in zip(*nodes))
    start = np.cumsum([0, *map(len, rows.thresholds)])
    threshold, inner = np.zeros(len(left)), left >= 0
    threshold[inner] = np.concatenate(rows.thresholds)[start[feature[inner]] + code[inner]]
    return Tree(left, feature, code, threshold, counts, gain, levels)


def _ends(rows: BinnedRows, tree: Tree, at: np.ndarray) -> np.ndarray:
    """The leaf in which each row ends."""
    end, going = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
    while len(going):
        now = end[going]
        inner = tree.left[now] >= 0
        going, now = going[inner], now[inner]
        end[going] = tree.left[now] + (rows.codes[at[going], tree.feature[now]] > tree.code[now])
    return end


def _ends_under(tree: Tree, limits: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """Per limit (depth, least rows to be split): the node that takes each leaf's place, for all nodes."""
    total = tree.counts.sum(axis=1)
    parent = np.full(len(total), 0)
    inner = np.flatnonzero(tree.left >= 0)
    parent[tree.left[inner]] = parent[tree.left[inner] + 1] = inner
    out = []
    for depth, split in limits:
        end = np.arange(len(total))
        for level, (a, b) in enumerate(zip(tree.levels[1:-1], tree.levels[2:]), start=1):
            over = parent[a:b]
            stopped = (end[over] != over) | (level > depth) | (total[over] < split)
            end[a:b] = np.where(stopped, end[over], end[a:b])
        out.append(end)
    return out


def _bag(rows: CodedRows, at: np.ndarray, rng: np.random.Generator, tree: int, seed: int) -> np.ndarray:
    """Draws per row: from the row's key where the table has one, as `curves.bag_weight` says, else from the tree's own numbers."""
    if "bag_key" not in rows.more:
        return rng.poisson(1.0, len(at))
    start = hashlib.md5(f"{seed}:{tree}:".encode())
    drawn = np.empty(len(at), dtype=np.int64)
    for i, key in enumerate(rows.more["bag_key"][at]):
        digest = start.copy()
        digest.update(key.encode())
        drawn[i] = int.from_bytes(digest.digest()[:4])
    return np.searchsorted(POISSON_EDGES, drawn / (1 << 32), side="right")


def _limits(fit: Fit) -> list[tuple[int, int]]:
    return sorted({(r.depth, r.split) for r in fit.rules})


def _trees(rows: CodedRows, fit: Fit, low: int, high: int, seed: int) -> Iterator[tuple[BinnedRows, np.ndarray, Tree]]:
    """Per tree: the binned rows, the rows that it did not draw from those it could, and the tree."""
    at = np.flatnonzero(fit.train)
    own = binned(rows, at)
    depth, split = max(r.depth for r in fit.rules), min(r.split for r in fit.rules)
    for k in range(low, high):
        rng = np.random.default_rng([seed & (1 << 64) - 1, k])
        weight = _bag(rows, at, rng, k, seed)
        yield own, at[weight == 0], grow(own, at, weight, rng, depth=depth, leaf=fit.leaf, split=split)


def _blocks(fits: Sequence[Fit]) -> list[tuple[int, int, int]]:
    """(fit, first tree, end) of each task; no block lies across a size at which votes are read."""
    out = []
    for k, fit in enumerate(fits):
        sizes = sorted({r.trees for r in fit.rules})
        edges = sorted({*sizes, *range(0, sizes[-1], TREES_PER_TASK)})
        out += [(k, a, b) for a, b in zip(edges, edges[1:])]
    return out


def judge(spark: SparkSession, rows: CodedRows, fits: Sequence[Fit], seed: int) -> list[list[tuple[int, int, int, int]]]:
    """Per fit and rule: (judged rows it learned from, of these predicted right, other judged rows, of these right).

    With `bag_key` among the further columns a tree votes for the rows that it did not draw, and only rows with a vote count.
    """
    blocks = _blocks(fits)
    shared = spark.sparkContext.broadcast((rows, list(fits)))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fits = shared.value
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            number, low, high = blocks[k]
            fit, at = fits[number], np.flatnonzero(fits[number].judged)
            limits = _limits(fit)
            sums = np.zeros((len(at), len(limits), rows.classes))
            for own, undrawn, tree in _trees(rows, fit, low, high, seed):
                heard = np.flatnonzero(np.isin(at, undrawn)) if "bag_key" in rows.more else slice(None)
                end = _ends(own, tree, at[heard])
                chance = tree.counts / np.maximum(tree.counts.sum(axis=1, keepdims=True), 1)
                for limit, under in enumerate(_ends_under(tree, limits)):
                    sums[heard, limit] += chance[under[end]]
            for chunk, first in enumerate(range(0, len(at), ROWS_PER_TALLY)):
                part = pa.array([sums[first:first + ROWS_PER_TALLY].tobytes()], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*(pa.array([v]) for v in (number, chunk, high)), part], names=["fit", "chunk", "upto", "votes"])

    def tally(table: pa.Table) -> pa.Table:
        rows, fits = shared.value
        number, chunk = table.column("fit")[0].as_py(), table.column("chunk")[0].as_py()
        fit, table = fits[number], table.sort_by("upto")
        at = np.flatnonzero(fit.judged)[chunk * ROWS_PER_TALLY:(chunk + 1) * ROWS_PER_TALLY]
        limits = _limits(fit)
        sums, found = np.zeros((len(at), len(limits), rows.classes)), []
        for upto, part in zip(table.column("upto").to_pylist(), table.column("votes")):
            sums += np.frombuffer(part.as_buffer()).reshape(sums.shape)
            voted = sums[:, 0].any(axis=1)
            for k, rule in enumerate(fit.rules):
                if rule.trees == upto:
                    right = sums[:, limits.index((rule.depth, rule.split))].argmax(axis=1) == rows.label[at]
                    for learned in (True, False):
                        own = voted & (fit.train[at] == learned)
                        found.append((number, k, learned, int(own.sum()), int(right[own].sum())))
        return pa.Table.from_pylist([dict(zip(("fit", "rule", "learned", "n", "hits"), f)) for f in found], schema=pa.schema(
            [("fit", pa.int64()), ("rule", pa.int64()), ("learned", pa.bool_()), ("n", pa.int64()), ("hits", pa.int64())]))

    try:
        told = spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(votes, "fit long, chunk long, upto long, votes binary")
        told = told.groupBy("fit", "chunk").applyInArrow(tally, "fit long, rule long, learned boolean, n long, hits long")
        sums = {(r.fit, r.rule, r.learned): (r.n, r.hits) for r in told.groupBy("fit", "rule", "learned").agg(
            F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()}
    finally:
        shared.destroy()
    return [[(*sums.get((k, i, True), (0, 0)), *sums.get((k, i, False), (0, 0))) for i in range(len(fit.rules))] for k, fit in enumerate(fits)]


# A tree as one row. `cut` has a bit per node, level by level: the children of the k-th node that is cut are the nodes 2k + 1 and 2k + 2.
# Features (in the fewest bytes) and thresholds belong to the nodes that are cut, counts by class (in the fewest bytes) to the leaves.
TREE_SCHEMA = "tree int, nodes int, cut binary, feature binary, threshold binary, counts binary"


def _fewest_bytes(values: np.ndarray) -> bytes:
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def unpacked(buffer: bytes, count: int) -> np.ndarray:
    """The numbers of `_fewest_bytes`."""
    return np.frombuffer(buffer, dtype=f"u{memoryview(buffer).nbytes // count}") if count else np.zeros(0, dtype=np.uint8)


def grown_trees(spark: SparkSession, rows: CodedRows, rule: Rule, leaf: int, seed: int) -> DataFrame:
    """A forest grown on all rows, written with the checkpoints. The driver sees none of it."""
    every = np.ones(len(rows.label), dtype=bool)
    fit = Fit(every, every, [rule], leaf)
    blocks = _blocks([fit])
    shared = spark.sparkContext.broadcast((rows, fit))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fit = shared.value
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            for number, (_, _, tree) in enumerate(_trees(rows, fit, *blocks[k][1:], seed), start=blocks[k][1]):
                inner = tree.left >= 0
                packed = {"cut": np.packbits(inner).tobytes(), "feature": _fewest_bytes(tree.feature[inner]),
                          "threshold": tree.threshold[inner].tobytes(), "counts": _fewest_bytes(tree.counts[~inner])}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], type=pa.int32()) for v in (number, len(inner))] + [pa.array([v], type=pa.binary()) for v in packed.values()],
                    names=["tree", "nodes", *packed])

    try:
        return spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(trees, TREE_SCHEMA).checkpoint()
    finally:
        shared.destroy()
