"""Ranks by bracketed selection: several rounds, ties, nulls, against sorting."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomcart.operators import ranks
from loomcart.operators.ranks import rows_at_ranks, select_ranks, with_ntiles
from tests.test_ranks_and_skew import _brute_ntile


@pytest.fixture
def small_samples(monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLE", 60)


def test_rounds_equal_brute_force(spark, small_samples):
    rng = random.Random(2)
    rows = [(None if rng.random() < 0.05 else 7 if rng.random() < 0.4 else rng.randrange(40), k, rng.random()) for k in range(4000)]
    df = spark.createDataFrame(rows, "v int, k bigint, w double").repartition(8)
    tiled = with_ntiles(df, 5, {"a": "v", "b": "w"}, "k").collect()
    assert {r["k"]: r["a"] for r in tiled} == _brute_ntile([(v, k) for v, k, _ in rows], 5)
    assert {r["k"]: r["b"] for r in tiled} == _brute_ntile([(w, k) for _, k, w in rows], 5)


def test_positions_near_each_other_and_at_the_ends(spark, small_samples):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(8)
    wanted = [1, 2, 3, 2499, 2500, 2501, 4999, 5000, 5001, 0]
    found = rows_at_ranks(df, ["x"], wanted)
    assert {r: row["x"] for r, row in found.items()} == {r: r - 1 for r in wanted if 1 <= r <= 5000}


def test_a_missed_bracket_is_made_good(spark, small_samples, monkeypatch):
    monkeypatch.setattr(ranks, "SPREAD", 0.01)
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("x"), F.lit(1).alias("y"))
    found = select_ranks(df, {"one": (["x"], [700, 1500]), "two": (["y", "x"], [2999])}, 3000)
    assert {r: row["x"] for r, row in found["one"].items()} == {700: 699, 1500: 1499}
    assert found["two"][2999] == {"y": 1, "x": 2998}


def test_rows_that_are_not_told_apart_are_an_error(spark, small_samples):
    with pytest.raises(ValueError, match="told apart"):
        rows_at_ranks(spark.range(500).select(F.lit(1).alias("x")), ["x"], [250])


def test_two_passes_over_the_rows(spark, small_samples, monkeypatch):
    scans = []
    real = ranks.materialise
    monkeypatch.setattr(ranks, "materialise", lambda df, label, **kw: scans.append(label) or real(df, label, **kw))
    df = spark.range(2500).select((F.col("id") % 50).alias("v"), (F.col("id") % 7).alias("w"), F.col("id").alias("k"))
    plans = []
    base = with_ntiles(df, 5, {"a": "v", "b": "w"}, "k")
    plans.append(base._jdf.queryExecution().executedPlan().toString())
    # One table for all orders of the first round; the deeper ones are written from it.
    assert scans[:2] == ["ntile", "brackets"]
    assert "Sort" not in plans[0] and "Window" not in plans[0]
