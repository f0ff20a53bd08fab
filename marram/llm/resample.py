"""Target-distribution importance resampling: documents whose hashed words look like a target's are drawn more often.

Every feature is hashed into one of a fixed number of buckets. The log ratio of the target's share of a bucket to the
corpus's is the bucket's gain, a document's weight is the mean gain of its features, and a Gumbel key of its id is added, so
that the highest sums are a sample without replacement by weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.tokens import IS_MARK, LOWER, MARK_WORD, Chunk, chunks, find_words
from marram.operators.ranking import running_totals, with_range_bucket
from marram.session import bucket_target, ensure_checkpoint_dir

BUCKETS = 10_000
SEED = 2024
# Rank error of the sketch is a row in so many.
ACCURACY = 10_000
# Different values of a bracket that are sorted together; a bracket of more is bracketed again.
BRACKET_VALUES = 1 << 20
HASHES = 1 << 32


def feature_buckets(chunk: Chunk, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document) of every run of 1 to `max_n` words of a chunk, and the number of words of each document."""
    words = find_words(chunk, IS_MARK)
    lower = LOWER[chunk.buf]
    length = words.end - words.start
    # The words, each followed by one space: a run of words is one slice.
    inside = np.ones(int(length.sum()) + len(length), dtype=bool)
    ends = np.cumsum(length + 1) - 1
    inside[ends] = False
    flat = np.full(len(inside), 32, dtype=np.uint8)
    firsts = ends - length
    flat[inside] = lower[np.arange(int(length.sum())) + np.repeat(words.start - (firsts - np.arange(len(firsts))), length)]
    text = flat.tobytes()
    found, docs = [], []
    for n in range(1, max_n + 1):
        first = np.arange(max(0, len(firsts) - n + 1))
        first = first[words.doc[first] == words.doc[first + n - 1]]
        spans = zip(firsts[first].tolist(), ends[first + n - 1].tolist())
        found.append(np.fromiter((crc32(text[a:b]) for a, b in spans), dtype=np.int64, count=len(first)) % buckets)
        docs.append(words.doc[first])
    return np.concatenate(found), np.concatenate(docs), words.count


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one row per bucket, whatever it read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                total += np.bincount(feature_buckets(chunk, max_n, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[np.asarray(sums.column("bucket"))] = np.asarray(sums.column("n"))
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares, in thousandths rounded down."""
    n_corpus, n_target, buckets = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (n_corpus + buckets) / ((float(s) + 1) * (n_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def with_weights(docs: DataFrame, gains: np.ndarray, max_n: int = 1) -> DataFrame:
    """(columns but `text`, _n_words, _n_features, _weight): the floored mean gain of each text's features, 0 without any."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept).schema
    for name in ("_n_words", "_n_features", "_weight"):
        schema = schema.add(name, "long")
    table = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), dtype=np.int64)
            for chunk in chunks(batch.column(batch.num_columns - 1)):
                rows = slice(chunk.first_row, chunk.first_row + chunk.n_docs)
                bucket, doc, out[0, rows] = feature_buckets(chunk, max_n, len(table.value))
                n = np.bincount(doc, minlength=chunk.n_docs)
                total = np.zeros(chunk.n_docs, dtype=np.int64)
                np.add.at(total, doc, table.value[bucket])
                out[1, rows], out[2, rows] = n, total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, out)], names=schema.names)

    return docs.select(*kept, "text").mapInArrow(run, schema)


def gumbel_key(doc_id: Column, seed: int = SEED) -> Column:
    """-1000 ln(-ln u) rounded down; u comes from the id alone. A null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(HASHES)
    return F.floor(F.log(-F.log(u)) * -1000).cast("long")


def value_at(rows: DataFrame, column: str, rank: int, n_rows: int, accuracy: int = ACCURACY,
             bracket_values: int = BRACKET_VALUES) -> tuple[int, int]:
    """(v, n): the value with which the `rank`-th row from the top ends, and the number of rows above v.

    A quantile sketch gives a bracket around the rank. Exact counts above and inside tell whether it holds the rank; if not,
    it is widened until it does. Only the bracket is sorted, its equal values folded. A bracket of too many different
    values is bracketed again by the same steps. `rows` is read a few times, so it should be written down before.
    """
    slack = 2.0 / accuracy
    while True:
        middle = 1.0 - rank / n_rows
        low, high = rows.agg(F.percentile_approx(column, [max(0.0, middle - slack), min(1.0, middle + slack)], accuracy)).first()[0]
        if slack >= 1.0:
            low, high = rows.agg(F.min(column), F.max(column)).first()
        inside = F.col(column).between(low, high)
        above, held = rows.agg(F.count_if(F.col(column) > high), F.count_if(inside)).first()
        if above < rank <= above + held:
            break
        slack *= 8
    values = rows.where(inside).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    if held < n_rows and values.count() > bracket_values:
        value, more = value_at(rows.where(inside), column, rank - above, held, accuracy, bracket_values)
        return value, above + more
    upto = F.sum("_n").over(Window.orderBy(F.desc(column)).rowsBetween(Window.unboundedPreceding, 0))
    row = values.withColumn("_upto", upto).where(F.col("_upto") >= rank - above).orderBy("_upto").first()
    return row[column], above + row["_upto"] - row["_n"]


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """`rank` for rows (doc_id, n_features, weight, score, tie) that hold the `drawn` first and those equal to the last of them.

    Equal rows are folded to one with a count before anything is ordered, and spread out again after. Score ranges from
    a sketch are ordered side by side.
    """
    same = ["doc_id", "n_features", "weight", "score", "tie"]
    folded = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).withColumn("_down", -F.col("score")).checkpoint()
    parts = bucket_target(rows.sparkSession)
    edges = folded.agg(F.percentile_approx("_down", [k / parts for k in range(1, parts)], ACCURACY)).first()[0] or []
    cut = with_range_bucket(folded, F.col("_down"), sorted({float(e) for e in edges}), "_range")
    order = [F.col("_down"), F.desc("tie"), F.col("n_features")]
    ended = running_totals(cut, {"_upto": F.col("_n")}, bucket=["_range"], order=order)
    rank = F.explode(F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    return ended.select(*same[:4], rank.alias("rank")).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))


def importance_report(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, max_n: int = 1,
                      buckets: int = BUCKETS, seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    Of the N documents with at least `min_words` words, the floor(percent * N / 100) with the highest scores are drawn; ties
    go to the smaller doc_id, null ids last. Undrawn documents have a null rank. Null and empty texts have no
    features, weight 0, and are never drawn. Rows equal in id and text share a score and have ranks of their own. An empty
    target or corpus counts nothing and leaves the smoothing; an empty corpus gives an empty result.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    narrow = docs.select("doc_id", "text")
    gains = bucket_gains(bucket_counts(narrow, max_n, buckets), bucket_counts(target, max_n, buckets))
    scored = with_weights(narrow, gains, max_n).select(
        "doc_id", F.col("_n_features").alias("n_features"), F.col("_weight").alias("weight"),
        (F.col("_weight") + gumbel_key(F.col("doc_id"), seed)).alias("score"),
        (F.col("_n_words") >= min_words).alias("eligible"),
        # Ids from small to large as a number from high to low.
        F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).alias("tie"))
    scored = scored.checkpoint()
    entered = scored.where("eligible")
    n_entered = entered.count()
    drawn = percent * n_entered // 100
    unranked = F.lit(None).cast("long").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    if drawn == 0:
        return scored.select(*columns, unranked)
    score, above = value_at(entered, "score", drawn, n_entered, accuracy)
    ties = entered.where(F.col("score") == score)
    tie, _ = value_at(ties, "tie", drawn - above, ties.count(), accuracy)
    first = F.col("eligible") & ((F.col("score") > score) | ((F.col("score") == score) & (F.col("tie") >= tie)))
    ranked = _ranked(scored.where(first).select(*columns, "tie"), drawn)
    return ranked.unionByName(scored.where(~first).select(*columns, unranked))


def resampled_documents(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents under their own columns. Of rows that share an id, all are taken if one of them is drawn."""
    drawn = importance_report(docs, target, **settings).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


# crc32 by its definition: eight shifts for each of 256 remainders, then one step a byte.
RESAMPLE_SQL = rf"""
with recursive shifts(b, k, r) as (
    select b, 0, b from range(256) t(b)
    union all
    select b, k + 1, case when (r & 1) = 1 then xor(r >> 1, {0xEDB88320}::bigint) else r >> 1 end from shifts where k < 8),
remainders as (select list(r order by b) as r from shifts where k = 8),
texts as (
    select doc_id, 's' as side, row_number() over () as row, text from documents
    union all select null, 't', row_number() over (), text from benchmark),
words as (
    select side, row, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{MARK_WORD}')) as word from texts),
hexed as (select word, lower(hex(encode(word))) as h from (select distinct word from words)),
hashed as (
    select word, xor(list_reduce(list_transform(range(1, length(h), 2), lambda p: ('0x' || substr(h, p, 2))::bigint),
        lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1]), {HASHES - 1}::bigint), {HASHES - 1}::bigint) % {BUCKETS} as bucket
    from hexed, remainders),
features as (select side, row, bucket from words join hashed using (word)),
counts as (select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t from features group by bucket),
totals as (select sum(s) as n_s, sum(t) as n_t from counts),
gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (n_s + {BUCKETS})::double
        / ((s + 1)::double * (n_t + {BUCKETS})::double)))::bigint as gain from counts, totals),
weights as (
    select row, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
    from features join gains using (bucket) where side = 's' group by row),
keyed as (
    select doc_id, row, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
    from texts where side = 's'),
scored as (
    select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::double) / {HASHES}::double))))::bigint as score
    from keyed left join weights using (row)),
placed as (
    select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last, n_features) as place,
           count(*) over (partition by n_features >= 20) as entered from scored)
select doc_id, n_features, weight, score,
       case when n_features >= 20 and place <= 10 * entered // 100 then place::bigint end as rank
from placed"""
