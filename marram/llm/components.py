"""Connected components by alternating large-star and small-star steps on distributed edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from marram.session import cores, ensure_checkpoint_dir, in_few_tasks


def _linked_to_least(edges: DataFrame, both_ways: bool, rows: int) -> DataFrame:
    """One star step on rows (u, v): every node's neighbours are linked to the least of them.

    The least neighbour is an aggregate, combined before the shuffle, and comes back by a join that splits
    hot nodes. So a node with very many neighbours is never gathered anywhere. `rows` is how many edges there are.
    """
    if both_ways:
        pairs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = pairs.join(least, "u")
    if both_ways:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return in_few_tasks(in_few_tasks(moved.where(F.col("u") != F.col("v")), rows).distinct(), rows)


def _signs(edges: DataFrame) -> Row:
    return edges.coalesce(cores(edges.sparkSession)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that has an edge; the root is the least node of its component.

    Rounds go on until nothing moves, a number that grows with the logarithm of the longest chain. Each
    round is written to the shared checkpoint folder, so lost executors cost one round at most; few edges are
    written in few files, however wide a shuffle is. Null ends and loops are not edges. No edges: an empty result.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u != v")
    now = now.distinct().checkpoint()
    state = _signs(now)
    # Stars never have more edges than the graph, so all rounds go on in as many tasks as its edges ask for.
    rows = state["rows"]
    now = in_few_tasks(now, rows)
    while rows:
        now = _linked_to_least(_linked_to_least(now, True, rows), False, rows).checkpoint()
        before, state = state, _signs(now)
        if state == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")))
    return in_few_tasks(nodes.distinct(), rows)
