from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from marram.operators.ranking import global_rank, running_totals, small_side, with_range_bucket
from marram.operators.splits import prefix_samples, stratified_kfold, stratified_split


def layouts(df):
    return [df.coalesce(1), df.repartition(2), df.repartition(7, "k")]


@pytest.fixture(scope="module")
def uneven(spark):
    """7, 11 and 13 rows per class, and one class name that is NULL."""
    rows = [(f"id{i}", c) for i, c in enumerate(["a"] * 7 + ["b"] * 11 + ["c"] * 13)]
    return spark.createDataFrame(rows, "k string, c string")


def test_split_sizes_and_exact_members(uneven):
    got = {r.k: (r.c, r.split) for r in stratified_split(uneven, "k", "c", 0.2, 5901).collect()}
    test = [k for k, (_, s) in got.items() if s == "test"]
    assert len(got) == 31 and len(test) == math.ceil(0.2 * 31)
    # remainders of 7 * (7, 11, 13) / 31 are 18, 15, 29 over 31: c and a get one more each
    quota = {"a": 2, "b": 2, "c": 3}
    for c, n in quota.items():
        order = sorted((hashlib.md5(f"5901:{k}".encode()).hexdigest(), k) for k, (cc, _) in got.items() if cc == c)
        assert {k for _, k in order[:n]} == {k for k in test if got[k][0] == c}


@pytest.mark.parametrize("digits", [1, 3])
def test_splits_and_folds_ignore_layout_and_bucket_count(uneven, digits):
    seen_split, seen_fold = set(), set()
    for df in layouts(uneven):
        seen_split.add(tuple(sorted((r.k, r.split) for r in stratified_split(df, "k", "c", digits=digits).collect())))
        seen_fold.add(tuple(sorted((r.k, r.fold) for r in stratified_kfold(df, "k", "c", digits=digits).collect())))
    assert len(seen_split) == 1 and len(seen_fold) == 1


def test_one_class_may_hold_almost_everything(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") < 19_990, "hot").otherwise("rare").alias("c"))
    n = {(r.c, r.split): r["count"] for r in stratified_split(df, "k", "c").groupBy("c", "split").count().collect()}
    assert n == {("hot", "test"): 3998, ("hot", "train"): 15992, ("rare", "test"): 2, ("rare", "train"): 8}


def test_null_class_keeps_its_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(20)], "k int, c string")
    assert stratified_split(df, "k", "c").count() == 20
    assert stratified_kfold(df, "k", "c", folds=3).where("fold is null").count() == 0


def test_strict_split_refuses_what_cannot_be_stratified(spark):
    lonely = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, c string")
    with pytest.raises(ValueError, match="at least two rows"):
        stratified_split(lonely, "k", "c", strict=True)
    with pytest.raises(ValueError, match="fewer rows than"):
        stratified_split(spark.createDataFrame([(i, "ab"[i % 2]) for i in range(4)], "k int, c string"), "k", "c", 0.1, strict=True)
    with pytest.raises(ValueError, match="empty"):
        stratified_split(lonely.where("k < 0"), "k", "c", strict=True)


def test_folds_differ_by_at_most_one(spark, uneven):
    rows = stratified_kfold(uneven, "k", "c", folds=5).collect()
    for names in ([None], ["a"], ["b"], ["c"]):
        sizes = [sum(r.fold == f and (names == [None] or r.c in names) for r in rows) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1, (names, sizes)
    tiny = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, c string")
    folds = sorted(r.fold for r in stratified_kfold(tiny, "k", "c", folds=5).collect())
    assert folds == [0, 1, 2]


def test_prefix_samples_are_nested_and_sized(uneven):
    folded = stratified_kfold(uneven, "k", "c", folds=5)
    rows = prefix_samples(folded, "k", "fold", folds=5).collect()
    largest = sum(r.fold != 0 for r in folded.collect())
    for f in range(5):
        mine = [r for r in rows if r.valid_fold == f]
        assert all(r.fold != f for r in mine)
        for step, frac in enumerate((0.2, 0.4, 0.6, 0.8, 1.0), start=1):
            held = [r for r in mine if r.first_step is not None and r.first_step <= step]
            assert len(held) == min(int(frac * largest), len(mine))


def test_rank_and_running_totals_match_plain_counting(spark):
    df = spark.range(1000).select("id", ((F.col("id") * 37) % 1000).alias("v"), (F.col("id") % 3 == 0).alias("g"))
    cut = with_range_bucket(df, F.col("v"), [10.0, 500.0, 990.0], "b")
    ranks = {r.id: r.rank for r in global_rank(cut, bucket=["b"], order=[F.col("v")]).collect()}
    assert all(ranks[i] == (i * 37) % 1000 + 1 for i in range(1000))
    sums = running_totals(cut, {"s": F.col("v")}, group=["g"], bucket=["b"], order=[F.col("v")]).collect()
    plain = {}
    for g in (True, False):
        total = 0
        for v, i in sorted(((i * 37) % 1000, i) for i in range(1000) if (i % 3 == 0) == g):
            total += v
            plain[i] = total
    assert {r.id: r.s for r in sums} == plain


def test_small_side_is_broadcast_only_within_its_limit(spark, capsys):
    df = spark.range(50).withColumn("x", F.lit("a"))
    for limit, literal in ((50, True), (49, False)):
        spark.range(5).join(small_side(df, limit), "id").explain()
        assert ("LocalTableScan" in capsys.readouterr().out) == literal


def test_strict_split_refuses_repeated_keys(spark):
    df = spark.createDataFrame([(k // 2, "ab"[k % 2]) for k in range(40)], "k long, c string")
    with pytest.raises(ValueError, match="not unique"):
        stratified_split(df, "k", "c", strict=True)
