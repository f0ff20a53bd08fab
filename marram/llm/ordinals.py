"""Numbers for rows that repeat, so that a group of equal rows can be cut anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.operators.ranking import running_totals
from marram.session import ensure_checkpoint_dir

# Equal rows are counted and numbered in so many parts.
SALTS = 64
# Groups of equal rows that are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_GROUPS = 100_000


def with_ordinals(docs: DataFrame, shares: int | None = None) -> DataFrame:
    """Every row with `_ordinal` (long): 0, 1, 2 … among the rows equal in doc_id and text, 0 where there is one.

    With `shares`, only groups of equal rows that hold more than one in so many of all rows or bytes are numbered, which are few
    in any table. Rows equal in all columns are counted in salted parts, written as one row with the count, and spread out
    again, so that which of them has which number never depends on where they lie, and no group is gathered in one task.
    Tables without such rows pass as they are.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    told = F.xxhash64(text)
    marks = docs.select("doc_id", told.alias("h"), (F.octet_length(text) + 8).alias("size")).groupBy("doc_id", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).checkpoint()
    large = F.col("n") > 1
    if shares is not None:
        rows, size = marks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
        large &= (F.col("n") * shares > rows) | (F.col("size") * shares > size)
    repeated = marks.where(large).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"))
    n_repeated = repeated.count()
    if n_repeated == 0:
        return docs.withColumn("_ordinal", F.lit(0).cast("long"))
    if n_repeated <= BROADCAST_GROUPS:
        repeated = F.broadcast(repeated)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (told == F.col("_h"))
    columns = docs.columns
    parts = docs.join(repeated, same, "left_semi").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    folded = parts.groupBy(*[F.col(c) for c in columns], "_salt").agg(F.count(F.lit(1)).alias("_n"))
    folded = folded.withColumns({"_h": told, "_row": F.xxhash64(*columns)}).checkpoint()
    ended = running_totals(folded, {"_upto": F.col("_n")}, group=["doc_id", "_h"], bucket=["_salt"], order=[F.col("_row")])
    numbers = F.explode(F.sequence(F.col("_upto") - F.col("_n"), F.col("_upto") - 1)).alias("_ordinal")
    single = docs.join(repeated, same, "left_anti").withColumn("_ordinal", F.lit(0).cast("long"))
    return single.unionByName(ended.select(*columns, numbers))
