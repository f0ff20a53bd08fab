"""Trees as tables: the nodes of a saved forest, forests cut back after the fit, and many settings judged in one pass.

A tree grown without a limit holds every tree with one: a depth limit or a least node size turns nodes into leaves that keep
their class counts, and a smaller forest is its first trees. So one fit serves all settings that differ in those three.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.session import drop_path, shared_root

# Rows x trees followed at once.
PLACES_AT_ONCE = 200_000


@dataclass(frozen=True)
class Rule:
    """Where a tree ends and how many trees vote."""

    trees: int
    depth: int
    split: int = 2


def node_table(spark: SparkSession, *paths: str) -> DataFrame:
    """(tree, node, left, right, feature, threshold, rows, counts) of saved forests; a tree is named by path and number.

    Children of a leaf are -1. `rows` is the number of rows of the bag that reached the node, `counts` their weighted counts by class.
    """
    tables = []
    for k, path in enumerate(paths):
        node = F.col("nodeData")
        tables.append(spark.read.parquet(f"{path}/data").select(
            F.struct(F.lit(k).alias("path"), F.col("treeID").alias("tree")).alias("tree"), node["id"].alias("node"),
            node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), node["rawCount"].alias("rows"),
            node["impurityStats"].alias("counts")))
    return reduce(DataFrame.union, tables)


class NodeArrays:
    """All nodes of a forest side by side, children as places in the arrays, depths from the roots.

    A fitted forest lies on the driver as a whole already; this is the same forest in a smaller form.
    """

    def __init__(self, nodes: DataFrame):
        flat = nodes.select("tree.path", "tree.tree", *[c for c in nodes.columns if c != "tree"])
        table = flat.toArrow().sort_by([("path", "ascending"), ("tree", "ascending"), ("node", "ascending")])
        column = lambda c: np.asarray(table.column(c).combine_chunks())
        tree = column("path").astype(np.int64) << 32 | column("tree")
        self.roots = np.flatnonzero(np.diff(tree, prepend=-1))
        start = np.repeat(self.roots, np.diff(self.roots, append=len(tree)))
        self.leaf = column("left") < 0
        self.left, self.right = (np.where(self.leaf, np.arange(len(tree)), column(c) + start) for c in ("left", "right"))
        self.feature = np.where(self.leaf, 0, column("feature"))
        self.threshold = np.nan_to_num(np.asarray(table.column("threshold").combine_chunks().fill_null(0.0)))
        self.rows = column("rows")
        counts = np.asarray(table.column("counts").combine_chunks().flatten()).reshape(len(tree), -1)
        self.chance = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)
        self.depth = np.zeros(len(tree), dtype=np.int64)
        now = self.roots
        while len(now):
            inner = now[~self.leaf[now]]
            now = np.concatenate([self.left[inner], self.right[inner]])
            self.depth[now] = np.concatenate([self.depth[inner], self.depth[inner]]) + 1

    def ends(self, x: np.ndarray, limits: Sequence[tuple[int, int]], trees: slice = slice(None)) -> list[np.ndarray]:
        """Per limit (depth, least rows to be split): the node in which each row ends in each tree."""
        now = np.broadcast_to(self.roots[trees], (len(x), len(self.roots[trees])))
        ended = [np.full(now.shape, -1) for _ in limits]
        row = np.arange(len(x))[:, None]
        while True:
            leaf = self.leaf[now]
            for end, (depth, split) in zip(ended, limits):
                stop = (end < 0) & (leaf | (self.depth[now] >= depth) | (self.rows[now] < split))
                end[stop] = now[stop]
            if leaf.all() or all((e >= 0).all() for e in ended):
                return ended
            now = np.where(x[row, self.feature[now]] <= self.threshold[now], self.left[now], self.right[now])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def hits_by_rule(held: DataFrame, nodes: NodeArrays, rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """(rows, rows predicted right) of a table (label, features) under each rule, in one pass and one job."""
    limits = sorted({(r.depth, r.split) for r in rules})
    shared = held.sparkSession.sparkContext.broadcast(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(rules), 2), dtype=np.int64)
        forest = shared.value
        step = max(1, PLACES_AT_ONCE // len(forest.roots))
        for batch in batches:
            label, x = np.asarray(batch.column(0)), _matrix(batch.column(1))
            for low in range(0, len(label), step):
                part = slice(low, low + step)
                ends = dict(zip(limits, forest.ends(x[part], limits)))
                for limit, end in ends.items():
                    votes = np.cumsum(forest.chance[end], axis=1)
                    for k, rule in enumerate(rules):
                        if (rule.depth, rule.split) == limit:
                            guess = votes[:, rule.trees - 1].argmax(axis=1)
                            found[k] += (len(guess), int((guess == label[part]).sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules))), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["rule", "n", "hits"])

    told = held.select("label", vector_to_array("features").alias("x")).mapInArrow(run, "rule long, n long, hits long")
    sums = {r.rule: (r.n, r.hits) for r in told.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()}
    return [sums.get(k, (0, 0)) for k in range(len(rules))]


def votes_out_of_bag(prepared: DataFrame, nodes: NodeArrays, out: Column, sizes: Sequence[int],
                     split: int = 2) -> list[tuple[int, int]]:
    """(rows with a vote, rows voted right) for the first trees of each size.

    `out` is an array of booleans per row: whether the row lies outside each tree's bag. A tree is followed for those rows only.
    """
    shared = prepared.sparkSession.sparkContext.broadcast(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(sizes), 2), dtype=np.int64)
        forest = shared.value
        for batch in batches:
            label, x = np.asarray(batch.column(0)), _matrix(batch.column(1))
            outside = np.asarray(batch.column(2).flatten().cast(pa.int8())).reshape(len(label), -1) > 0
            votes = np.zeros((len(label), forest.chance.shape[1]))
            tree = 0
            for k, size in enumerate(sizes):
                for tree in range(tree, size):
                    rows = np.flatnonzero(outside[:, tree])
                    if len(rows):
                        end = forest.ends(x[rows], [(1 << 30, split)], slice(tree, tree + 1))[0][:, 0]
                        votes[rows] += forest.chance[end]
                tree = size
                voted = outside[:, :size].any(axis=1)
                found[k] += (int(voted.sum()), int((votes.argmax(axis=1) == label)[voted].sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sizes), type=pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["size", "n", "hits"])

    told = prepared.select("label", vector_to_array("features").alias("x"), out.alias("out")).mapInArrow(
        run, "size long, n long, hits long")
    sums = {r["size"]: (r.n, r.hits) for r in told.groupBy("size").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()}
    return [sums.get(s, (0, 0)) for s in sizes]


def saved(model, folder: str) -> str:
    path = f"{folder}/{uuid.uuid4().hex}"
    model.write().save(path)
    return path


def with_folder(spark: SparkSession, work: Callable[[str], object]) -> object:
    """Run `work` with a folder of its own below the shared one, removed afterwards."""
    folder = f"{shared_root(spark)}/trees-{uuid.uuid4().hex}"
    try:
        return work(folder)
    finally:
        drop_path(spark, folder)


def _cut_back(split: int) -> Callable[[pa.Table], pa.Table]:
    """One tree's nodes (as stored) with every node of fewer rows than `split` made a leaf, numbered anew in the same order."""

    def run(table: pa.Table) -> pa.Table:
        nodes = sorted((r["nodeData"] for r in table.to_pylist()), key=lambda n: n["id"])
        kept, todo = [], [0]
        while todo:
            node = nodes[todo.pop()]
            if node["leftChild"] >= 0 and node["rawCount"] < split:
                node.update(leftChild=-1, rightChild=-1, gain=-1.0,
                            split={"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1})
            elif node["leftChild"] >= 0:
                todo += [node["rightChild"], node["leftChild"]]
            kept.append(node)
        place = {n["id"]: k for k, n in enumerate(kept)} | {-1: -1}
        moved = [{**n, "id": place[n["id"]], "leftChild": place[n["leftChild"]], "rightChild": place[n["rightChild"]]} for n in kept]
        tree = table.column("treeID")[0].as_py()
        return pa.Table.from_pylist([{"treeID": tree, "nodeData": n} for n in moved], schema=table.schema)

    return run


def split_limited(spark: SparkSession, model, split: int, folder: str):
    """The forest with no cut of a node of fewer than `split` rows: such nodes are leaves with their own counts.

    A saved forest's nodes are rewritten tree by tree and loaded as a model like any other.
    """
    path = saved(model, folder)
    stored = spark.read.parquet(f"{path}/data")
    stored.groupBy("treeID").applyInArrow(_cut_back(split), stored.schema).write.parquet(f"{path}-cut/data")
    spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{path}-cut/treesMetadata")
    spark.read.text(f"{path}/metadata").write.text(f"{path}-cut/metadata")
    loaded = RandomForestClassificationModel.load(f"{path}-cut")
    # The loaded object lets go of its forest when it goes; the model of the caller's type has one of its own.
    again = type(model)(loaded._java_obj.copy(loaded._empty_java_param_map()))
    again._transfer_params_from_java()
    return again

