"""Repeats where rows and ids occur more than once, against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marram.llm import suffixes
from tests.llm.test_dedup import _repeats


@pytest.mark.parametrize("hot", [3, 20_000])
def test_repeated_rows_are_no_earlier_copies(spark, hot):
    rng = np.random.default_rng(11)
    piece = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = piece(150)
    rows = [(1, piece(80) + shared + piece(80)), (2, piece(90) + shared + piece(70)), (3, piece(300)), (4, piece(60) + shared)]
    # Each row in a task of its own, so copies meet only in the shuffle.
    df = spark.createDataFrame(rows + rows[:3] + rows[:1], "doc_id long, text string").repartition(8)
    want = {r[0]: r for r in _repeats(spark.createDataFrame(rows, df.schema).collect())}
    got = Counter(tuple(r) for r in suffixes.without_repeats(df, hot=hot).drop("kept").collect())
    assert got == Counter(want[r.doc_id] for r in df.collect()) and want[1][2] == 0 and want[2][2] > 0


def test_texts_under_one_id_are_ordered_by_hash(spark):
    """No number of a text is packed beside its start, so neither can run into the other."""
    df = spark.createDataFrame([(None, "a" * 120), (None, "b" * 120), (7, "c" * 120), (7, "c" * 120)], "doc_id long, text string")
    keyed = suffixes._keyed(df)
    assert "Window" not in keyed._jdf.queryExecution().toString()
    assert {r._copy for r in keyed.collect()} == {r.h for r in df.selectExpr("xxhash64(text) as h").collect()}
    place = (1 << 40) << suffixes.START_BIT | 1 << suffixes.SETTLED_BIT | 77
    row = spark.range(1).select(suffixes._start(F.lit(place)).alias("start"), suffixes._windows(F.lit(place)).alias("n")).first()
    assert tuple(row) == (1 << 40, 77)
