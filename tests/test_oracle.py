"""Every registered report with SQL, against DuckDB on the whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from tests.compare import duck, mismatch

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with duck(FOLDER) as connection:
        yield connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    assert mismatch(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
