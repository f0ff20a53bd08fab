"""Small tables leave few files, however wide a shuffle is."""

from __future__ import annotations

import os
from contextlib import contextmanager

import corpus_pipeline
import pytest

from marram import session
from marram.llm.components import components
from tests.llm.conftest import DOCS

WIDTH = 64


@pytest.fixture
def wide(spark):
    """Shuffles of WIDTH partitions that Spark does not join to fewer."""
    conf = {"spark.sql.shuffle.partitions": str(WIDTH), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _parts(spark):
    """Part files by checkpoint."""
    found = {}
    for top, _, names in os.walk(session.shared_root(spark).removeprefix("file://")):
        if n := sum(x.startswith("part-") for x in names):
            found[top] = n
    return found


@contextmanager
def _written(spark, into):
    before = _parts(spark)
    yield
    into += [n for top, n in _parts(spark).items() if top not in before]


def test_rounds_of_components_are_written_in_few_files(wide):
    files = []
    edges = wide.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (502, 501)], "u long, v long")
    with _written(wide, files):
        found = {r.node: r.root for r in components(edges).collect()}
    assert found == {k: 0 for k in range(201)} | {500: 500, 501: 500, 502: 500}
    # The edges as they come are as wide as a shuffle, the rounds after them are not.
    assert len(files) > 3 and sorted(files)[-2] <= session.cores(wide) < WIDTH


def test_components_without_edges(wide):
    assert components(wide.createDataFrame([(None, 1), (2, 2)], "u long, v long")).collect() == []


def test_near_dedup_writes_few_files(wide):
    base = [f"w{k}" for k in range(120)]
    rows = [(10 * a + k, " ".join([f"g{a}", *base[a:], *(["end"] * k)])) for a in (0, 40, 60) for k in range(3)]
    docs = wide.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    files = []
    with _written(wide, files):
        got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(wide, docs, "").collect())
    assert got == [0, 400, 600]
    assert sum(n > session.cores(wide) for n in files) * 2 < len(files)


def test_tables_that_fill_a_shuffle_stay_as_they_are(wide):
    rows = wide.range(1000).repartition(WIDTH)
    count = lambda df: df.selectExpr("spark_partition_id() as p").distinct().count()
    assert count(session.in_few_tasks(rows, session.ROWS_PER_TASK * WIDTH)) == WIDTH
    assert count(session.in_few_tasks(rows, session.ROWS_PER_TASK * (WIDTH - 1))) == WIDTH - 1
    assert count(session.kept(rows)) == session.cores(wide) and session.count_written(rows) == 1000
