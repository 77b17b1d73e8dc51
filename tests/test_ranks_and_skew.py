"""Distributed ranks, splits and salted lookups against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomcart.operators.lookup import hot_keys, lookup
from loomcart.operators.ranks import rows_at_ranks, with_ntiles
from loomcart.operators.split import random_split, stratified_split


def _brute_ntile(rows, buckets):
    """rows: (value, key) -> bucket by key; nulls first, ties by key."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
    size, extra = divmod(len(order), buckets)
    out, at = {}, 0
    for b in range(1, buckets + 1):
        for _ in range(size + (b <= extra)):
            out[order[at][1]] = b
            at += 1
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 4001])
def test_distributed_ntile_equals_brute_force(spark, n):
    rng = random.Random(n)
    # A third of the rows share one value, and some values are null.
    rows = [(None if rng.random() < 0.05 else 7 if rng.random() < 0.33 else rng.randrange(40), k) for k in range(n)]
    df = spark.createDataFrame(rows, "v int, k bigint").repartition(8)
    tiled = with_ntiles(df, 5, {"t": "v"}, "k")
    assert {r["k"]: r["t"] for r in tiled.collect()} == _brute_ntile(rows, 5)


def test_distributed_ntile_never_uses_one_task(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("v"), F.col("id").alias("k"))
    tiled = with_ntiles(df, 5, {"t": "v"}, "k")
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_ntile_ties_go_by_key(spark):
    df = spark.createDataFrame([(1, k) for k in (7, 6, 5, 4, 3, 2, 1)], "v int, k bigint")
    tiles = {r["k"]: r["t"] for r in with_ntiles(df, 5, {"t": "v"}, "k").collect()}
    assert tiles == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 4, 7: 5}


def test_rows_at_ranks(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(8)
    found = rows_at_ranks(df, ["x"], [1, 500, 1000, 1001, 0])
    assert {rank: row["x"] for rank, row in found.items()} == {1: 0, 500: 499, 1000: 999}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain_join(spark, how):
    rng = random.Random(1)
    # One key holds a third of the rows, one holds nulls, some keys are unknown to the dimension.
    keys = [rng.choice([5, 5, 5, None, *range(100, 1200)]) if rng.random() < 0.5 else rng.choice([5, 900 + i % 400]) for i in range(6000)]
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key bigint, row bigint").repartition(8)
    dim = spark.createDataFrame([(k, f"v{k}") for k in range(1000)], "key bigint, v string")
    salted = lookup(fact, dim, "key", spread="row", how=how, dim_bytes_limit=-1)
    plain = fact.join(dim, "key", how)
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))
    known = dim.select("key")
    filtered = lookup(fact, known, "key", spread="row", how="inner", dim_bytes_limit=-1)
    assert sorted(map(repr, filtered.collect())) == sorted(map(repr, fact.join(known, "key").collect()))


def test_salted_lookup_spreads_the_hot_key(spark):
    fact = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("key"), F.col("id").alias("row")
    )
    dim = spark.range(20_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = lookup(fact, dim, "key", spread="row", dim_bytes_limit=-1)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(sizes) == 20_000
    # Unsalted, one of 8 partitions would hold at least a third of all rows.
    assert max(sizes) < 20_000 / 3 * 0.8, sizes
    assert dict(hot_keys(fact, "key"))[1] > 4


def test_rows_of_a_hot_key_without_spread_are_split(spark):
    fact = spark.range(4000).select(F.lit(1).alias("key"), F.lit(None).cast("long").alias("row"))
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "key long, v string")
    joined = lookup(fact.repartition(8), dim, "key", spread="row", dim_bytes_limit=-1)
    assert joined.count() == 4000 and joined.where("v = 'a'").count() == 4000


def test_random_split_ignores_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "customer_id")
    two = {r[0] for r in random_split(df.repartition(2)).where("is_test").select("customer_id").collect()}
    eight = {r[0] for r in random_split(df.repartition(8)).where("is_test").select("customer_id").collect()}
    assert two == eight
    assert 0.17 < len(two) / 5000 < 0.23


def test_stratified_split_is_exact_on_any_partitioning(spark):
    df = spark.range(997).select(F.col("id").alias("customer_id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    small = stratified_split(df.repartition(2), "y")
    large = stratified_split(df.repartition(8), "y")
    counts = {(r["y"], r["is_test"]): r["count"] for r in small.groupBy("y", "is_test").count().collect()}
    assert counts[(0, True)] == 149 and counts[(1, True)] == 50  # 20% of 747 and of 250, halves up
    key = ["customer_id", "y", "is_test"]
    assert sorted(map(tuple, small.select(key).collect())) == sorted(map(tuple, large.select(key).collect()))


def test_stratified_split_with_one_label(spark):
    df = spark.range(10).select(F.col("id").alias("customer_id"), F.lit(1).alias("y"))
    split = stratified_split(df, "y")
    assert split.where("is_test").count() == 2


def test_builtin_window_matches_spark_ntile(spark):
    df = spark.range(1003).select((F.col("id") % 10).alias("v"), F.col("id").alias("k"))
    ours = with_ntiles(df, 5, {"t": "v"}, "k")
    theirs = df.withColumn("t", F.ntile(5).over(Window.orderBy("v", "k")))
    assert ours.exceptAll(theirs.select(ours.columns)).isEmpty()
