"""Every registered query against its SQL on the benchmark tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
