"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not found")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_contract_functions_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) == ""
