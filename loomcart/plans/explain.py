"""Shapley attributions of a boosted-tree margin, computed row by row on the executors.

The value of a feature set is the tree's expectation when the features outside
the set follow the training rows through both children. Per leaf this is a
product with one factor for each feature of its path: 1 or 0 for a known feature
that passes or fails, the share of training rows that pass for an unknown one.
The sums over all sets of one size are the coefficients of a polynomial, which is
extended by one feature after the other and from which each is divided out again,
so the work grows with the square of the path, not with the number of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.plans.churn import ChurnRun
from loomcart.plans.trees import saved_nodes
from loomcart.session import ship_package


@dataclass(frozen=True)
class Condition:
    """A row passes when the feature is above ``low``, at most ``high`` and, for a category, allowed."""

    low: float
    high: float
    allowed: frozenset[float] | None


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, for each feature of its path, the condition and the share of training rows that pass it."""

    features: list[int]
    conditions: list[Condition]
    shares: list[float]
    value: float

    @property
    def expected(self) -> float:
        return self.value * math.prod(self.shares)


def contributions(value: float, shares: list[float], passed: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf's features for every row of ``passed`` (rows x features of 0 and 1)."""
    n = len(shares)
    known = passed.astype(float)
    # Coefficient s: the sum over all sets of s known features of the product of all factors.
    sums = np.zeros((len(known), n + 1))
    sums[:, 0] = 1.0
    for j, share in enumerate(shares):
        sums[:, 1:] = share * sums[:, 1:] + known[:, j, None] * sums[:, :-1]
        sums[:, 0] *= share
    weights = np.array([math.factorial(s) * math.factorial(n - 1 - s) / math.factorial(n) for s in range(n)])
    out = np.empty((len(known), n))
    for i, share in enumerate(shares):
        without = sums[:, :n] / share
        divided = np.empty_like(without)
        divided[:, n - 1] = sums[:, n]
        for s in range(n - 1, 0, -1):
            divided[:, s - 1] = sums[:, s] - share * divided[:, s]
        own = np.where(known[:, i, None] > 0, divided, without)
        out[:, i] = value * (known[:, i] - share) * (own @ weights)
    return out


def _merge(test: Condition | None, split, goes_left: bool) -> Condition:
    low, high, allowed = (test.low, test.high, test.allowed) if test else (-math.inf, math.inf, None)
    if split["numCategories"] < 0:
        threshold = split["leftCategoriesOrThreshold"][0]
        return Condition(low, min(high, threshold), allowed) if goes_left else Condition(max(low, threshold), high, allowed)
    left = frozenset(split["leftCategoriesOrThreshold"])
    side = left if goes_left else frozenset(float(c) for c in range(split["numCategories"])) - left
    return Condition(low, high, side if allowed is None else allowed & side)


def leaves_of(nodes: dict[int, object], tree_weight: float) -> Iterator[Leaf]:
    pending = [(nodes[0], {}, {})]
    while pending:
        node, tests, odds = pending.pop()
        if node["leftChild"] < 0:
            value = tree_weight * node["prediction"]
            features = sorted(tests)
            share = [odds[f] for f in features]
            yield Leaf(features, [tests[f] for f in features], share, value)
            continue
        feature = node["split"]["featureIndex"]
        for child_id, goes_left in ((node["leftChild"], True), (node["rightChild"], False)):
            child = nodes[child_id]
            cover = child["rawCount"] / node["rawCount"]
            pending.append(
                (
                    child,
                    {**tests, feature: _merge(tests.get(feature), node["split"], goes_left)},
                    {**odds, feature: odds.get(feature, 1.0) * cover},
                )
            )


def attribute(matrix: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    phi = np.zeros_like(matrix)
    for leaf in leaves:
        if not leaf.features:
            continue
        passed = np.empty((len(matrix), len(leaf.features)), bool)
        for i, (feature, test) in enumerate(zip(leaf.features, leaf.conditions)):
            x = matrix[:, feature]
            passed[:, i] = (x > test.low) & (x <= test.high)
            if test.allowed is not None:
                passed[:, i] &= np.isin(x, list(test.allowed))
        # Rows that pass the same conditions are worked out once.
        keys = np.zeros((len(matrix), -(-len(leaf.features) // 64) * 8), np.uint8)
        packed = np.packbits(passed, axis=1)
        keys[:, : packed.shape[1]] = packed
        keys = keys.view(np.uint64)
        _, first, same = np.unique(keys.ravel() if keys.shape[1] == 1 else keys, axis=0, return_index=True, return_inverse=True)
        phi[:, leaf.features] += contributions(leaf.value, leaf.shares, passed[first])[same.ravel()]
    return phi


def explain_margin(run: ChurnRun, rows: DataFrame) -> DataFrame:
    """(customer_id, margin, base, phi): ``base`` plus the sum of ``phi`` is the margin."""
    spark = rows.sparkSession
    ship_package(spark)
    trees = saved_nodes(spark, run.model)
    leaves = [leaf for t, nodes in sorted(trees.items()) for leaf in leaves_of(nodes, run.model.treeWeights[t])]
    base = float(sum(leaf.expected for leaf in leaves))
    shared = spark.sparkContext.broadcast(leaves)

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                phi = attribute(np.stack(batch["x"].to_list()).astype(float), shared.value)
                yield pd.DataFrame(
                    {"customer_id": batch["customer_id"], "margin": batch["margin"], "base": base, "phi": list(phi)}
                )

    return rows.select(
        "customer_id",
        vector_to_array("rawPrediction")[1].alias("margin"),
        vector_to_array("features").alias("x"),
    ).mapInPandas(per_batch, "customer_id bigint, margin double, base double, phi array<double>")


def churn_explain(run: ChurnRun, top: int = 10) -> DataFrame:
    """Mean absolute attribution per feature over the test part."""
    explained = explain_margin(run, run.scored.where("is_test"))
    means = explained.agg(*[F.avg(F.abs(F.col("phi")[i])).alias(f"f{i}") for i in range(len(run.names))])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(f"f{i}").alias("mean_abs_attribution"))
            for i, name in enumerate(run.names)
        ]
    )
    return means.select(F.inline(rows)).orderBy(F.desc("mean_abs_attribution"), "feature").limit(top)
