"""Mixing and sharding where one id, or none, holds a third of the rows, and where weights lie far apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marram.llm import mixing, ordinals, sharding
from tests.llm.conftest import DOCS

TEXT = " ".join(f"w{k}" for k in range(12))


@pytest.fixture(scope="module", params=[None, 77])
def crowded(spark, request):
    rows = [(request.param, TEXT, "en", "a", 1)] * 400
    rows += [(1000 + k, f"{TEXT} own{k}", "en", "ab"[k % 2], k) for k in range(800)]
    return spark.createDataFrame(rows, DOCS).repartition(7)


def test_ordinals_number_equal_rows(crowded, odd_docs, no_docs):
    rows = ordinals.with_ordinals(crowded).collect()
    assert len(rows) == 1200
    assert sorted(r._ordinal for r in rows if r.text == TEXT) == list(range(400))
    assert all(r._ordinal == 0 for r in rows if r.text != TEXT)
    odd = ordinals.with_ordinals(odd_docs)
    assert odd.columns == [*odd_docs.columns, "_ordinal"]
    assert sorted((r.doc_id or 0, r._ordinal) for r in odd.collect() if r._ordinal or r.doc_id == 5) == [(5, 0), (5, 1)]
    assert ordinals.with_ordinals(no_docs).collect() == []


def test_targets_are_met_among_equal_rows(crowded):
    taken = mixing.mix_report(crowded).groupBy("source_size", "target").agg(
        F.sum("taken").alias("taken"), F.max("size").alias("longest")).collect()
    assert len(taken) == 2
    for r in taken:
        assert abs(r.taken - r.target) <= r.longest / 2 + 1


def test_shards_are_even_with_one_id(crowded):
    rows = sharding.shard_report(crowded, 6).groupBy("shard").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots")).collect()
    mean = sum(r.bytes for r in rows) / 6
    assert len(rows) == 6 and all(abs(r.bytes - mean) <= 0.05 * mean for r in rows)
    assert all(r.n == r.slots == r["last"] + 1 for r in rows)
    whole = sharding.sharded_documents(crowded, 6)
    assert whole.count() == 1200 and whole.select("shard", "slot").distinct().count() == 1200


def test_ranges_stay_small_under_any_weight(spark):
    u = (F.col("id") + 0.5) / 200_000
    for weight in (1.0, 0.5, 0.1, 0.001):
        keys = spark.range(200_000).select(mixing._range_of(-F.log(u) / weight).alias("r"))
        assert keys.groupBy("r").count().agg(F.max("count")).first()[0] < 2000


def test_mix_keeps_a_column_named_col(spark, odd_docs):
    docs = odd_docs.withColumn("col", F.lit("own"))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r.col for r in mixed.select("col").collect()} == {"own"}
