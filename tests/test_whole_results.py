"""Nothing is cut, dropped or skipped: long texts, null times and labels, features without values, empty sides."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marram.functions.features import with_label_code
from marram.functions.hashing import poisson_one
from marram.functions.text import STORE_PATH_MARK, STORE_PREFIX, parse_store_uri, strip_prefix
from marram.operators import drift, metrics, profiles
from marram.operators.timing import trailing_threshold

from marram.sources.readers import read_requests


def test_long_texts_are_whole(spark):
    df = spark.range(1).select(F.repeat(F.lit("x"), 1_200_000).alias("t"))
    name = strip_prefix(F.concat(F.lit("model__"), "t"))
    path = parse_store_uri(F.concat(F.lit(STORE_PREFIX + "s" + STORE_PATH_MARK), "t"))["path"]
    assert tuple(df.select(F.length(name), F.length(path)).first()) == (1_200_000, 1_200_000)


def test_rows_without_time_stay(spark):
    df = spark.sql("select 1L id, 's' s, timestamp'2024-01-01' t, 99.0 v union all select 2L, 's', null, 99.0")
    rows = trailing_threshold(df, row_id="id", series="s", time="t", value="v").collect()
    assert {r.id for r in rows} == {1, 2} and len([r for r in rows if r.id == 1]) == len([r for r in rows if r.id == 2])
    assert all(r["mean"] is None and not r.fires for r in rows if r.id == 2)


@pytest.mark.parametrize("exact", [True, False])
def test_feature_without_values_has_a_profile(spark, exact):
    df = spark.sql("select 1.0D a, cast(null as double) b union all select 2.0D, null")
    rows = {r.feature: r for r in profiles.feature_profile(df, ["a", "b"], exact=exact).collect()}
    assert set(rows) == {"a", "b"} and rows["b"].q50 is None and rows["a"].q50 is not None


def test_drift_of_empty_sides_is_null(spark):
    df = spark.sql("select 1.0D a, cast(null as double) b, false cur union all select 2.0D, null, false")
    binned = {r.feature: r for r in drift.binned_drift(df, F.col("cur"), {"a": [1.5], "b": [0.0]}).collect()}
    assert set(binned) == {"a", "b"} and binned["b"].psi is None
    exact = drift.exact_drift(df, "a", F.col("cur")).first()
    assert exact.feature == "a" and exact.ks is None and exact.wasserstein_1 is None
    share = drift.categorical_drift(df.select(F.lit("x").alias("l"), "cur"), "l", F.col("cur")).first()
    assert share.labels == 1 and share.total_variation is None


def test_nan_takes_no_part_in_distances(spark):
    df = spark.sql("select 1.0D a, false cur union all select double('NaN'), false union all select 2.0D, true")
    row = drift.exact_drift(df, "a", F.col("cur")).first()
    assert row.ks == 1.0 and row.wasserstein_1 == 1.0


def test_null_labels_count_everywhere(spark):
    df = spark.sql("select 'a' y, 'a' p union all select null, 'a' union all select null, null union all select 'a', null")
    counts = metrics.confusion_counts(df, "y", "p")
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(counts).collect()}
    assert cells == {("a", "a"): 1, (None, "a"): 1, (None, None): 1, ("a", None): 1}
    assert metrics.accuracy(df, "y", "p").first().accuracy == 0.5
    whole = metrics.weighted_metrics(counts).first()
    assert whole.accuracy == 0.5 and whole.n_rows == 4


def test_strict_labels_name_all(spark):
    df = spark.range(250).select(F.concat(F.lit("label"), "id").alias("y"))
    with pytest.raises(ValueError, match="250 unsupported labels") as error:
        with_label_code(df, "y", {"a": 0}, strict=True)
    path = str(error.value).split("all of them in ")[1].split(";")[0]
    assert spark.read.parquet(path).count() == 250


def test_poisson_series_has_no_end(spark):
    top = spark.range(1).select(poisson_one(F.lit(math.nextafter(1.0, 0.0)))).first()[0]
    assert top > 12


def test_request_ids_do_not_depend_on_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f'{{"x": {k % 700}}}\n' for k in range(2000)))
    ids = []
    for size in ("1024", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        ids.append(sorted(r.request_id for r in read_requests(spark, str(tmp_path)).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids[0] == ids[1] and len(set(ids[0])) == 2000


def test_edges_split_tied_values():
    from marram.operators.ranking import _even_edges

    sample = np.concatenate([np.full(198_000, 0.5), np.linspace(0, 1, 2000)])
    edges = _even_edges(sample, 64)
    load = np.bincount(np.searchsorted(edges, np.unique(sample), side="right"))
    assert len(edges) >= 32 and load.max() <= 2 * 2001 / 64 + 1
