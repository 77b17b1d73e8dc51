"""Checks for the keys and references that Spark does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from loomcart.sources.star import Star


def _rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def primary_key_report(star: Star) -> DataFrame:
    """Per table: rows, distinct non-null keys, rows beyond the first of a key, null keys."""
    def report(table: str, key: str) -> DataFrame:
        present = F.col("key").isNotNull()
        return (
            _rows_per_key(star.bare(table), key)
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                F.count_if(present).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(present, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
                F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_keys"),
            )
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "*")
        )

    return reduce(DataFrame.unionByName, [report(t, k) for t, k in PRIMARY_KEYS.items()])


def foreign_key_report(star: Star) -> DataFrame:
    """Per reference: fact rows with a key, and the rows and keys the dimension lacks.

    The fact side is counted per key before the anti-join, so a hot key is one row.
    """
    def report(fact: str, column: str, dim: str, dim_key: str) -> DataFrame:
        keys = _rows_per_key(star.bare(fact).where(F.col(column).isNotNull()), column)
        known = star.bare(dim).select(F.col(dim_key).alias("key"), F.lit(True).alias("known"))
        if PRIMARY_KEYS[dim] != dim_key:
            known = known.distinct()
        lost = F.col("known").isNull()
        return (
            keys.join(known, "key", "left")
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("referencing_rows"),
                F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
                F.count_if(lost).alias("orphan_keys"),
            )
            .select(
                F.lit(f"{fact}.{column}").alias("reference"),
                F.lit(f"{dim}.{dim_key}").alias("target"),
                "*",
            )
        )

    return reduce(DataFrame.unionByName, [report(*fk) for fk in FOREIGN_KEYS])
