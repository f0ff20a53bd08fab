"""Mixing sources to target weights: whole epochs, then weighted sampling by exponential keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.ordinals import with_ordinals
from marram.llm.tokens import with_counts
from marram.session import ensure_checkpoint_dir

SALT = "mix-1"
# Key ranges per doubling of the key, whatever its magnitude. Only the range that holds a source's cut is ever sorted.
RANGES = 1 << 11
# Source tables up to this many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def quality_weight(words: Column, symbols: Column) -> Column:
    """1 for text without symbols, down to 0.1 for a symbol on every word and more."""
    return F.greatest(F.lit(0.1), F.lit(1.0) / (F.lit(1.0) + symbols.cast("double") / F.greatest(words, F.lit(1))))


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(text, F.lit("")))))


def _order_key(row_key: Column, weight: Column) -> Column:
    """Efraimidis and Spirakis: -ln(u) / w. Rows with the least keys are a sample without replacement by w."""
    u = (F.conv(F.substring(F.md5(F.concat(row_key, F.lit(SALT))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _range_of(key: Column) -> Column:
    """Keys of a weight w are spread over 1/w, so a range is a share of an order of magnitude."""
    return F.floor(F.log2(key) * RANGES).cast("int")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes. A target stops at
    `cap` times its source's size and the excess goes to the others by weight. That ends with one level L
    such that every target is min(cap * size, L * weight); L is read off the sources sorted by the level
    at which they stop. One row per source, so the windows here are over a small table.
    """
    everything, by_name = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in cycle])
    ranked = sizes.withColumn("w", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(cycle) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * cap)
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.sum("cap").over(rising) - F.col("cap"))
        .withColumn("open_weight", F.sum("w").over(everything) - F.sum("w").over(rising) + F.col("w"))
        .withColumn("level", (F.col("total") - F.col("capped")).cast("double") / F.col("open_weight"))
    )
    # The first source that its level does not fill up fixes the level; those after it would set a lower one.
    fits = F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))
    return levels.withColumn("level", F.max(fits).over(everything)).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def _cuts(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole epochs, the range that holds the cut, and the last key taken in that range."""
    spans = narrow.groupBy("source", "range").agg(F.sum("size").alias("n"))
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
        F.lit(3), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    order = Window.partitionBy("source").orderBy("range")
    before = spans.withColumn("before", F.sum("n").over(order) - F.col("n"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    held = before.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source"))).where(
        "b.before <= p.rest and p.rest < b.before + b.n").select("b.source", "b.range", "b.before", "p.rest").checkpoint()
    # One row per source. Written, it no longer lies by source, which would draw all rows of a source to one task.
    held = F.broadcast(held) if held.count() <= BROADCAST_SOURCES else held
    inside = narrow.alias("r").join(held.alias("h"), F.col("r.source").eqNullSafe(F.col("h.source"))
                                    & (F.col("r.range") == F.col("h.range")))
    inside = inside.select("r.source", "r.key", "r.row_key", "r.tie", "r.size", "h.before", "h.rest")
    running = Window.partitionBy("source").orderBy("key", "row_key", "tie")
    middle = F.col("before") + F.sum("size").over(running) - F.col("size") / 2
    last = inside.withColumn("taken", middle <= F.col("rest")).where("taken").groupBy("source").agg(
        F.max(F.struct("key", "row_key", "tie")).alias("last"))
    plan = plan.join(held.select(F.col("source").alias("hs"), F.col("range").alias("cut_range")),
                     F.col("source").eqNullSafe(F.col("hs")), "left").drop("hs")
    return plan.join(last.select(F.col("source").alias("ls"), "last"),
                     F.col("source").eqNullSafe(F.col("ls")), "left").drop("ls")


def with_mix(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Every document with `_mix`: size, source_size, target, copies, taken.

    A document is taken once per whole epoch of its source, and once more if its key lies within the rest of
    the budget: rows in key order are taken while the middle of the row is within the rest, so a source
    misses its target by half a document at most. Null texts have size 0; null sources are one source;
    a null id is keyed by its text. Rows equal in id and text share a key and are told apart by a number, so that some of them
    may be taken. Nothing depends on partitions or runs. An empty table gives an empty result.

    A source of any size is summed by key range; one range per source is sorted.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    tie = F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.col("_ordinal").alias("k"))
    numbered = with_ordinals(docs).withColumns({"_row_key": _row_key(F.col("doc_id"), F.col("text")), "_tie": tie}).drop("_ordinal")
    keyed = with_counts(numbered, keep_text=keep_text)
    keyed = keyed.withColumn("_key", _order_key(F.col("_row_key"), quality_weight(F.col("_words"), F.col("_symbols"))))
    keyed = keyed.withColumn("_range", _range_of(F.col("_key")))
    narrow = keyed
    if not keep_text:
        keyed = narrow = keyed.checkpoint()
    narrow = narrow.select("source", F.col("_words").alias("size"), F.col("_key").alias("key"),
                           F.col("_row_key").alias("row_key"), F.col("_tie").alias("tie"), F.col("_range").alias("range"))
    if keep_text:
        narrow = narrow.checkpoint()
    targets = source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"))).checkpoint()
    cuts = _cuts(narrow, targets).withColumnRenamed("source", "_cut_source").checkpoint()
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    joined = keyed.join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")))
    extra = F.when(F.col("_range") == F.col("cut_range"), F.coalesce(
        F.struct(F.col("_key").alias("key"), F.col("_row_key").alias("row_key"), F.col("_tie").alias("tie")) <= F.col("last"),
        F.lit(False)))
    extra = extra.otherwise(F.coalesce(F.col("_range") < F.col("cut_range"), F.lit(False)))
    copies = F.col("epochs") + extra.cast("long")
    mix = F.struct(F.col("_words").alias("size"), F.col("source_size"), F.col("target"), copies.alias("copies"),
                   (copies * F.col("_words")).alias("taken"))
    columns = [c for c in docs.columns if keep_text or c != "text"]
    return joined.select(*columns, mix.alias("_mix"))


def mix_report(docs: DataFrame) -> DataFrame:
    m = F.col("_mix")
    return with_mix(docs.select("doc_id", "source", "text"), keep_text=False).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        m["taken"].alias("taken"), m["copies"].alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, under its own columns."""
    m = with_mix(docs).where("_mix.copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix.copies")))
    return m.select(*docs.columns, copies.alias("_mix_copy")).drop("_mix_copy")


MIX_SQL = rf"""
with d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as symbols,
           coalesce(doc_id::varchar, 'null ' || md5(coalesce(text, ''))) as row_key
    from documents),
keyed as (
    select *, -ln((('0x' || substr(md5(row_key || '{SALT}'), 1, 13))::bigint::double + 0.5) / {1 << 52}::double)
        / greatest(0.1, 1.0::double / (1.0::double + symbols::double / greatest(size, 1))) as key
    from d),
sources as (
    select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
           [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
    from d group by source),
levels as (
    select *, (sum(source_size) over () - (sum(cap) over r - cap))::double
        / (sum(w) over () - sum(w) over r + w)::double as own_level
    from sources window r as (order by cap::double / w, source nulls last rows unbounded preceding)),
targets as (
    select *, least(cap::double, w * max(case when own_level <= cap::double / w then own_level end) over ()) as target
    from levels),
plan as (
    select *, case when source_size > 0 then least(3, floor(target / source_size))::bigint else 0 end as epochs
    from targets),
ordered as (
    select k.doc_id, k.size, p.source_size, p.target, p.epochs,
           sum(k.size) over (partition by k.source order by key, row_key rows unbounded preceding)
               - k.size / 2.0 <= p.target - p.epochs * p.source_size as extra
    from keyed k join plan p on k.source is not distinct from p.source)
select doc_id, size, source_size, target, (epochs + extra::bigint)::bigint as copies,
       ((epochs + extra::bigint) * size)::bigint as taken
from ordered"""
