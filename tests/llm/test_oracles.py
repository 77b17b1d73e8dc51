"""Operators that SQL can express, against DuckDB on whole tables."""

from __future__ import annotations

import pytest

from loomcart.llm.oracle import oracle_sql
from loomcart.llm.registry import queries
from tests.compare import duck, mismatch

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, name):
    with duck(FOLDER) as con:
        assert mismatch(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None
