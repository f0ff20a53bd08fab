"""Every registered query against its SQL, and the driver's contract."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from tools.compare import compare, connect

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    assert compare(contract.queries()[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sorted(r.return_flag for r in rows) == ["A", "N", "R"]
    assert sum(r.n for r in rows) == 6000
