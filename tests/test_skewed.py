"""Reports on a copy with hot keys, every join by shuffle, against DuckDB."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.compare import duck, mismatch

SOURCE = "/root/testdata/sf0.001"
REPORTS = [
    "load_report", "dq_primary_key", "dq_foreign_key", "ab_tagging", "line_totals", "order_values", "rfm_segments", "star_revenue",
    "sliced_kpis", "filtered_measure", "revenue_by_category", "ab_readout", "ab_aov", "clv_features", "churn_features", "kpi_cards",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines on one order, a third on one product, a third of the orders on one customer; some unknown."""
    folder = str(tmp_path_factory.mktemp("skewed"))

    def bent(column, key, hot, lost):
        spread = F.pmod(F.xxhash64(F.lit(column), *key), F.lit(30))
        return F.when(spread < 10, hot).when(spread == 10, lost).otherwise(F.col(column)).cast("long").alias(column)

    changes = {
        "orders": [("o_custkey", ["o_orderkey"], 7, 10**9)],
        "lineitem": [("l_orderkey", ["l_partkey", "l_linenumber"], 11, 10**9), ("l_partkey", ["l_orderkey", "l_extendedprice"], 5, 10**9)],
    }
    for table in ("orders", "lineitem", "customer", "part", "nation"):
        df = spark.read.parquet(f"{SOURCE}/{table}.parquet")
        df = df.withColumns({c: bent(c, key, hot, lost) for c, key, hot, lost in changes.get(table, [])})
        df.write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.fixture
def by_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", REPORTS)
def test_matches_duckdb(spark, skewed, by_shuffle, name):
    with duck(skewed) as con:
        assert mismatch(registry.queries()[name](spark, skewed), con, registry.oracle_sql()[name]) is None
