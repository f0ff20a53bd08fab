"""Exact stratified splits, folds and nested samples, each a pure function of (key, seed, sizes).

Rows are ordered by a seeded digest of their key. A split is then a set of cut points in that
order, one per class (or fold): finding them needs counts per digest prefix and a look at the few
buckets they fall into, and applying them is a comparison per row. The table itself is never
shuffled or sorted, so a class with a third of all rows costs what any other does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.functions.features import quoted
from marram.functions.hashing import prefix_digits, seeded_md5
from marram.operators.ranking import SMALL_ROWS, rows_at_rank, small_side
from marram.session import bucket_target

DEFAULT_SEED = 5901  # fixed value: the default seed of splits and models
DEFAULT_TEST_SIZE = 0.2  # fixed value
WIDE = "decimal(38,0)"


def _digested(df: DataFrame, key: str, seed: int, digits: int | None) -> DataFrame:
    digits = digits or prefix_digits(bucket_target(df.sparkSession))
    return df.withColumn("__h", seeded_md5(seed, quoted(key))).withColumn(
        "__p", F.substring("__h", 1, digits)
    )


def _upto(key: str, cut_digest: Column, cut_key: Column) -> Column:
    """Whether the row stands at or before a cut; plain comparisons, so it compiles."""
    digest = F.col("__h")
    return (digest < cut_digest) | ((digest == cut_digest) & (quoted(key) <= cut_key))


def _check_sizes(sizes: DataFrame, test_size: float) -> None:
    """The library's own refusals: too few rows to give every class a place on both sides."""
    row = sizes.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"), F.sum("n").alias("n"),
                    F.first("n_test").alias("t")).first()
    if not row.k:
        raise ValueError("cannot split an empty table")
    if row.least < 2:
        raise ValueError("every class needs at least two rows for a stratified split")
    if row.t < row.k or row.n - row.t < row.k:
        raise ValueError(f"test_size={test_size} leaves fewer rows than the {row.k} classes on one side")


def _check_unique(df: DataFrame, key: str) -> None:
    repeated = df.groupBy(quoted(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if repeated is not None:
        raise ValueError(f"key {key} is not unique: {repeated.key!r} has {repeated.n} rows")


def split_quotas(df: DataFrame, label: str, test_size: float = DEFAULT_TEST_SIZE) -> DataFrame:
    """Test rows per class by largest remainder; the total is ceil(test_size * rows).

    The tables here have one row per class.
    """
    sizes = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))
    whole = sizes.withColumn("all", F.sum("n").over(every)).withColumn(
        "n_test", F.ceil(F.lit(float(test_size)) * F.col("all").cast("double")).cast("long")
    )
    product = F.col("n_test").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    shared = whole.withColumn("rest", F.pmod(product, F.col("all").cast("decimal(19,0)"))).withColumn(
        "base", ((product - F.col("rest")) / F.col("all")).cast("long")
    )
    turn = F.row_number().over(every.orderBy(F.desc("rest"), "label"))
    spare = F.col("n_test") - F.sum("base").over(every)
    return shared.select(
        "label", "n", "n_test", (F.col("base") + (turn <= spare).cast("int")).alias("quota")
    )


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    *,
    out: str = "split",
    strict: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Add a `train`/`test` column with exact class quotas. `key` must be unique; `strict` checks that and the sizes."""
    digested = _digested(df, key, seed, digits)
    quotas = split_quotas(df, label, test_size)
    if strict:
        _check_sizes(quotas, test_size)
        _check_unique(df, key)
    wanted = quotas.where("quota > 0").select(
        F.struct("label").alias("__g"), F.lit("test").alias("target"), F.col("quota").alias("want")
    )
    placed = digested.withColumn("__g", F.struct(quoted(label).alias("label")))
    cuts = rows_at_rank(placed.select("__g", "__p", "__h", quoted(key)), wanted,
                        group=["__g"], bucket="__p", order=["__h", key])
    limits = small_side(cuts.select("__g", F.col("__h").alias("__ch"), quoted(key).alias("__ck")))
    inside = F.coalesce(_upto(key, F.col("__ch"), F.col("__ck")), F.lit(False))
    return (
        placed.join(limits, "__g", "left")
        .withColumn(out, F.when(inside, "test").otherwise("train"))
        .drop("__g", "__p", "__h", "__ch", "__ck")
    )


def fold_sizes(df: DataFrame, label: str, folds: int) -> DataFrame:
    """Rows of each class in each fold, as a round-robin over the label-sorted table deals them.

    Class c covers the sorted positions [s, s + n); fold i gets those congruent to i.
    """
    sizes = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(1)).orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("s", F.coalesce(F.sum("n").over(before), F.lit(0)))
    dealt = placed.select(
        "label", "n", "s", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    )
    upto = lambda edge: F.floor((edge - 1 - F.col("fold")) / F.lit(folds))
    return dealt.select("label", "fold", (upto(F.col("s") + F.col("n")) - upto(F.col("s"))).cast("long").alias("rows"))


def stratified_kfold(
    df: DataFrame,
    key: str,
    label: str,
    folds: int = 5,
    seed: int = DEFAULT_SEED,
    *,
    out: str = "fold",
    digits: int | None = None,
) -> DataFrame:
    """Add a fold number. Fold sizes and class counts per fold differ by at most one.

    Each class is cut, in digest order, into contiguous runs of the allotted sizes.
    """
    digested = _digested(df, key, seed, digits).withColumn("__g", F.struct(quoted(label).alias("label")))
    sizes = fold_sizes(df, label, folds)
    upto = Window.partitionBy("label").orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    ends = sizes.withColumn("want", F.sum("rows").over(upto)).where((F.col("fold") < folds - 1) & (F.col("want") > 0))
    wanted = ends.select(F.struct("label").alias("__g"), F.col("fold").alias("target"), "want")
    cuts = rows_at_rank(digested.select("__g", "__p", "__h", quoted(key)), wanted,
                        group=["__g"], bucket="__p", order=["__h", key])
    at = lambda i, c: F.max(F.when(F.col("target") == i, c))
    per_class = cuts.groupBy("__g").agg(
        *[at(i, F.col("__h")).alias(f"__ch{i}") for i in range(folds - 1)],
        *[at(i, quoted(key)).alias(f"__ck{i}") for i in range(folds - 1)],
    )
    # A class smaller than the fold count may leave its first folds empty: it starts that much later.
    leading = sizes.withColumn("want", F.sum("rows").over(upto)).where("want = 0").groupBy("label").agg(
        F.count(F.lit(1)).alias("__empty")
    )
    per_class = per_class.join(
        leading.select(F.struct("label").alias("__g"), "__empty"), "__g", "full_outer"
    )
    number = F.coalesce(F.col("__empty"), F.lit(0)).cast("int")
    for i in range(folds - 1):
        passed = ~_upto(key, F.col(f"__ch{i}"), F.col(f"__ck{i}"))
        number = number + F.coalesce(passed, F.lit(False)).cast("int")
    return digested.join(small_side(per_class), "__g", "left").withColumn(out, number).select(
        *[quoted(c) for c in df.columns], quoted(out)
    )


def with_prefix_steps(
    df: DataFrame,
    key: str,
    fold: str,
    folds: int = 5,
    fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0),
    seed: int = DEFAULT_SEED,
    *,
    out: str = "prefix_steps",
    digits: int | None = None,
) -> DataFrame:
    """Nested samples of every training fold, for learning curves, as one array per row.

    Element f (0-based) is the smallest sample (1-based) of the training fold that leaves out f
    and holds this row: NULL when the row is in f or in no sample. Sizes are floor(fraction * rows
    of the first training fold), one size list for all folds. Rows are never multiplied.
    """
    digested = _digested(df, key, seed, digits)
    others = lambda: F.explode_outer(F.filter(
        F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != quoted(fold))).alias("valid_fold")
    # Counts per (fold, prefix) first; spreading them over the training folds is then a small step.
    counts = digested.groupBy(quoted(fold), "__p").agg(F.count(F.lit(1)).alias("n"))
    counts = small_side(counts, limit=SMALL_ROWS * folds)
    cells = counts.select(others(), "__p", "n").groupBy("valid_fold", "__p").agg(F.sum("n").alias("n"))
    have = {r.valid_fold: r.n for r in cells.groupBy("valid_fold").agg(F.sum("n").alias("n")).collect()}
    sizes = sample_sizes(have.get(0, 0), fractions)
    targets = [(f, step, min(n, have.get(f, 0))) for f in range(folds)
               for step, n in enumerate(sizes, start=1)]
    wanted = df.sparkSession.createDataFrame(
        [t for t in targets if t[2] > 0], "valid_fold int, target int, want long")
    # At most folds x fractions cut points: plain constants from here on.
    cuts = rows_at_rank(
        digested.select("__p", "__h", quoted(key), quoted(fold)), wanted, group=["valid_fold"], bucket="__p",
        order=["__h", key], cells=cells, widen=lambda rows: rows.select("__p", "__h", quoted(key), others()),
    ).collect()
    if not cuts:
        return df.withColumn(out, F.array_repeat(F.lit(None).cast("int"), folds))
    # Written out as comparisons of plain columns, the steps compile; lambdas over a list would not.
    key_type = df.schema[key].dataType
    steps = []
    for f in range(folds):
        step = F.lit(None).cast("int")
        for cut in sorted((c for c in cuts if c.valid_fold == f), key=lambda c: -c.target):
            held = _upto(key, F.lit(cut["__h"]), F.lit(cut[key]).cast(key_type))
            step = F.when(held, F.lit(cut.target)).otherwise(step)
        steps.append(F.when(quoted(fold) != f, step))
    steps = F.array(*steps)
    return digested.withColumn(out, steps).drop("__p", "__h")


def prefix_samples(df: DataFrame, key: str, fold: str, folds: int = 5, **how: object) -> DataFrame:
    """`with_prefix_steps` in long form: (…, valid_fold, first_step) per row and training fold."""
    stepped = with_prefix_steps(df, key, fold, folds, out="__steps", **how)
    # The array is never empty; the outer form keeps Spark from testing that in a filter of its own,
    # which would compute the steps twice.
    tall = stepped.select("*", F.posexplode_outer("__steps").alias("valid_fold", "first_step"))
    return tall.where(F.col("valid_fold") != quoted(fold)).drop("__steps")


def sample_sizes(rows: int, fractions: Sequence[float]) -> list[int]:
    return [int(f * rows) for f in fractions]


def split_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on both sides: empty for a correct split."""
    return left.select(quoted(key)).join(right.select(quoted(key)), key, "left_semi")
