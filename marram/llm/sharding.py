"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.ordinals import with_ordinals
from marram.llm.tokens import with_counts
from marram.session import ensure_checkpoint_dir

# Small groups are packed in bundles, this many per shard. A group of more than 1/32 of a shard is packed on
# its own, and one of more than 1/4 of a shard is cut into pieces of at most 1/8.
BUNDLES_PER_SHARD = 128
ALONE_PER_SHARD = 32
CUT_ABOVE, PIECE = 8, 4  # in units of 1/32 of a shard
# Rows of a packed item are numbered in so many parts, each a task's sort of its own.
PARTS = 16


def pack(items: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item (rows of bytes, tokens, rows), largest first.

    An item goes where the dot product of its vector with the residual capacity is highest. Both are in
    shares of a shard's fair part; ties go to the lower shard.
    """
    fair = np.maximum(items.sum(axis=0), 1) / n_shards
    vectors = items / fair
    residual = np.ones((n_shards, items.shape[1]))
    shards = np.zeros(len(items), dtype=np.int64)
    for k in np.lexsort((np.arange(len(items)), -vectors.max(axis=1))):
        shards[k] = best = int(np.argmax(residual @ vectors[k]))
        residual[best] -= vectors[k]
    return shards


def with_shards(docs: DataFrame, n_shards: int = 24, keep_text: bool = True) -> DataFrame:
    """Every row with `_size`, `_text_crc32`, `_shard` and `_slot` (gapless from 0 within the shard).

    Groups are equal texts (null texts are one group of empty ones). A group stays together while it is
    no larger than 1/4 of a shard; larger ones are cut by id, and by a number where an id repeats, into pieces of about 1/8, or
    no packing could be even. The packer sees bundles of small groups and those pieces, a few thousand vectors for any
    table, so it runs on the driver; so do the sizes of their parts. Slots come from the sizes of the packed items and of
    16 parts by id of each, and a numbering within a part, never within a whole shard. Repeated rows get slots of their own.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = with_ordinals(docs, n_shards * ALONE_PER_SHARD).withColumns({
        "_text_crc32": F.crc32(text), "_group": F.xxhash64(text),
        "_id_hash": F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("_ordinal"))})
    keyed = with_counts(keyed, keep_text=keep_text).withColumn("_size", F.col("_bytes") + 8)
    if not keep_text:
        keyed = keyed.checkpoint()
    narrow = keyed.select("_group", "_text_crc32", "_id_hash", "_size", "_words")
    if keep_text:
        narrow = narrow.checkpoint()
    totals = narrow.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count(F.lit(1))).first()
    parts = n_shards * ALONE_PER_SHARD
    # At most 2 * parts groups can be over either share, so this table is small for any input.
    need = F.ceil(F.greatest(F.sum("_size") * parts / max(totals[0], 1), F.count(F.lit(1)) * parts / max(totals[1], 1)))
    large = narrow.groupBy("_group", "_text_crc32").agg(need.cast("int").alias("_units")).where("_units > 1")
    large = large.select("_group", "_text_crc32", F.when(F.col("_units") > CUT_ABOVE, F.ceil(F.col("_units") / PIECE))
                         .otherwise(1).cast("int").alias("_pieces")).checkpoint()

    def itemised(rows: DataFrame) -> DataFrame:
        marked = rows.join(F.broadcast(large), ["_group", "_text_crc32"], "left")
        alone = F.col("_pieces").isNotNull()
        return marked.withColumns({
            "_item": F.when(alone, F.col("_group")).otherwise(F.pmod("_group", F.lit(n_shards * BUNDLES_PER_SHARD))),
            "_piece": F.when(alone, F.pmod("_id_hash", F.col("_pieces"))).otherwise(-1).cast("int"),
            "_part": F.pmod(F.shiftright("_id_hash", 24), F.lit(PARTS)).cast("int")}).drop("_pieces")

    spans = itemised(narrow).groupBy("_item", "_piece", "_part").agg(
        F.sum("_size").alias("bytes"), F.sum("_words").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    spans = spans.orderBy("_item", "_piece", "_part").toPandas()
    items = spans.groupby(["_item", "_piece"], sort=True)
    shard = pack(items[["bytes", "tokens", "rows"]].sum().to_numpy(dtype=np.float64), n_shards)[items.ngroup().to_numpy()]
    # Within a shard, parts follow each other in the order of the table.
    offset = spans["rows"].groupby(shard).cumsum() - spans["rows"]
    places = spark.createDataFrame(
        [tuple(map(int, r)) for r in zip(spans["_item"], spans["_piece"], spans["_part"], shard, offset)],
        "_item long, _piece int, _part int, _shard int, _offset long")
    order = Window.partitionBy("_item", "_piece", "_part").orderBy("doc_id", "_text_crc32", "_ordinal")
    placed = itemised(keyed).join(F.broadcast(places), ["_item", "_piece", "_part"])
    columns = [c for c in docs.columns if keep_text or c != "text"]
    return placed.withColumn("_slot", F.col("_offset") + F.row_number().over(order) - 1).select(
        *columns, "_size", "_text_crc32", "_shard", "_slot")


def shard_report(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    return with_shards(docs.select("doc_id", "text"), n_shards, keep_text=False).select(
        "doc_id", F.col("_size").alias("size"), F.col("_text_crc32").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The documents under their own columns, plus `shard` and `slot` (columns of these names are replaced)."""
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return with_shards(docs, n_shards).select(*own, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
