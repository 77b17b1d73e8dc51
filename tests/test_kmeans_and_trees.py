"""K-means passes, tree tables and attributions against plain code."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loomcart.operators import kmeans
from loomcart.plans import explain, trees
from tests.test_models import churn_run, planted  # noqa: F401

COLUMNS = ["a", "b", "c"]


def plain_step(x, centroids):
    """Members, cost and mean of each centroid's points."""
    distance = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    place = distance.argmin(axis=1)
    return {
        k: (int((place == k).sum()), float(distance[place == k, k].sum()), x[place == k].mean(axis=0))
        for k in range(len(centroids))
        if (place == k).any()
    }


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(5, 3)) * 6
    x = np.concatenate([m + rng.normal(size=(300, 3)) for m in middles])
    return x, spark.createDataFrame([tuple(map(float, p)) for p in x], "a double, b double, c double").repartition(5)


def test_a_pass_serves_models_of_any_size(points):
    x, df = points
    rng = np.random.default_rng(5)
    models = [rng.normal(size=(k, 3)) * 5 for k in (1, 2, 7)]
    got: dict = {}
    for r in kmeans.lloyd_pass(df, COLUMNS, models).collect():
        got[r["model"], r["cluster"]] = (r["n"], r["cost"], np.array(r["sums"]) / r["n"])
    want = {(m, k): v for m, c in enumerate(models) for k, v in plain_step(x, c).items()}
    assert got.keys() == want.keys()
    for key, (n, cost, mean) in want.items():
        assert got[key][0] == n and got[key][1] == pytest.approx(cost) and got[key][2] == pytest.approx(mean)


def test_step(points):
    x, df = points
    centroids = x[[0, 500, 900]]
    want = plain_step(x, centroids)
    for r in kmeans.kmeans_step(df, COLUMNS, centroids).collect():
        n, cost, mean = want[r["cluster"]]
        assert (r["n"], r["inertia"]) == (n, pytest.approx(cost)) and [r[c] for c in COLUMNS] == pytest.approx(list(mean))


def test_fits_rest_and_find_planted_groups(points, monkeypatch):
    x, df = points
    passes = []
    real = kmeans.lloyd_pass
    monkeypatch.setattr(kmeans, "lloyd_pass", lambda p, c, m: passes.append(len(m)) or real(p, c, m))
    found = kmeans.fit_many(df, COLUMNS, [2, 5, 6], 6, 42, 100)
    assert passes[0] == passes[-1] == 18 and len(passes) < 60 and sorted(passes[:-1], reverse=True) == passes[:-1]
    centroids, cost = found[5]
    assert cost == pytest.approx(sum(v[1] for v in plain_step(x, centroids).values()))
    assert cost < 1.02 * sum(((g - g.mean(axis=0)) ** 2).sum() for g in np.split(x, 5))
    assert found[2][1] > cost > found[6][1]
    again = kmeans.fit_many(df.repartition(2), COLUMNS, [5], 6, 42, 100)
    assert again[5][1] == pytest.approx(cost)


def test_fits_on_few_or_no_points(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)] * 4, "a double, b double, c double")
    assert kmeans.fit_many(df, COLUMNS, [3], 2, 1, 10)[3][1] == 0
    assert kmeans.fit_many(df.limit(0), COLUMNS, [3], 2, 1, 10) == {}


def test_scores_equal_the_models_own(spark, churn_run):  # noqa: F811
    nodes = trees.node_table(spark, churn_run.model)
    scored = trees.with_margin(churn_run.scored, nodes, vector_to_array("features"), "scored")
    own = scored.select(vector_to_array("rawPrediction")[1].alias("margin"), "p", "scored")
    gap = own.select(F.abs(F.col("margin") - F.col("scored")).alias("m"), F.abs(F.col("p") - trees.probability(F.col("scored"))).alias("p"))
    assert max(gap.agg(F.max("m"), F.max("p")).first()) < 1e-9
    assert trees.node_table(spark, churn_run.model).select("tree").distinct().count() == 5


def test_missing_features_go_right_and_no_tree_is_no_margin(spark):
    rows = [(0, 0, 0, 1.5, None, 1, 2, None, 2.0, 1.0)] + [(0, i, -1, None, None, None, None, 3.0 - 2 * i, 1.0, None) for i in (1, 2)]
    x = spark.createDataFrame([([1.0],), ([2.0],), ([None],)], "x array<double>")
    assert [r["margin"] for r in trees.with_margin(x, trees.tree_rows(spark, rows), F.col("x")).collect()] == [1.0, -1.0, -1.0]
    assert [r["margin"] for r in trees.with_margin(x, trees.tree_rows(spark, []), F.col("x")).collect()] == [0.0] * 3


def test_attributions_of_deep_paths(spark):
    """A tree of depth 15 over five features, against the definition."""
    rng = np.random.default_rng(1)
    nodes: dict = {}

    def grow(depth, cover):
        number = len(nodes)
        nodes[number] = None
        if depth == 15 or cover < 2 or (depth > 3 and rng.random() < 0.3):
            nodes[number] = {"leftChild": -1, "rightChild": -1, "prediction": float(rng.normal()), "rawCount": cover}
            return number
        split = {"featureIndex": int(rng.integers(5)), "leftCategoriesOrThreshold": [float(rng.normal())], "numCategories": -1}
        part = max(1, int(cover * rng.uniform(0.2, 0.8)))
        left = grow(depth + 1, part)
        right = grow(depth + 1, cover - part)
        nodes[number] = {"leftChild": left, "rightChild": right, "split": split, "rawCount": cover, "prediction": 0.0}
        return number

    def chain(depth):
        """The longest path has all 15 steps, each on another of 20 features."""
        out = {}
        for i in range(depth):
            split = {"featureIndex": i, "leftCategoriesOrThreshold": [0.0], "numCategories": -1}
            out[2 * i] = {"leftChild": 2 * i + 1, "rightChild": 2 * i + 2, "split": split, "rawCount": 1 << (depth - i), "prediction": 0.0}
            out[2 * i + 1] = {"leftChild": -1, "rightChild": -1, "prediction": float(i), "rawCount": 1 << (depth - i - 1)}
        out[2 * depth] = {"leftChild": -1, "rightChild": -1, "prediction": 50.0, "rawCount": 1}
        return out

    def value(tree, node, x, known):
        if node["leftChild"] < 0:
            return node["prediction"]
        left, right = tree[node["leftChild"]], tree[node["rightChild"]]
        f = node["split"]["featureIndex"]
        if f in known:
            return value(tree, left if x[f] <= node["split"]["leftCategoriesOrThreshold"][0] else right, x, known)
        return (left["rawCount"] * value(tree, left, x, known) + right["rawCount"] * value(tree, right, x, known)) / node["rawCount"]

    grow(0, 100_000)
    leaves = list(explain.leaves_of(nodes, 0.5))
    x = rng.normal(size=(4, 5))
    phi = explain.attribute(x, leaves)
    for row, own in zip(x, phi):
        for f in range(5):
            others = [u for u in range(5) if u != f]
            want = sum(
                math.factorial(k) * math.factorial(4 - k) / math.factorial(5) * (value(nodes, nodes[0], row, {*s, f}) - value(nodes, nodes[0], row, set(s)))
                for k in range(5)
                for s in combinations(others, k)
            )
            assert own[f] == pytest.approx(0.5 * want, abs=1e-9)
    deep = chain(15)
    x = rng.normal(size=(50, 15))
    phi = explain.attribute(x, list(explain.leaves_of(deep, 1.0)))
    base = value(deep, deep[0], x[0], set())
    assert phi.sum(axis=1) == pytest.approx([value(deep, deep[0], row, set(range(15))) - base for row in x], abs=1e-9)
    assert max(len(leaf.features) for leaf in explain.leaves_of(deep, 1.0)) == 15


def test_importances_equal_the_models_own(spark, churn_run):  # noqa: F811
    names = churn_run.names
    got = {r["feature"]: r["importance"] for r in trees.importance(trees.node_table(spark, churn_run.model), names).collect()}
    want = churn_run.model.featureImportances.toArray()
    assert [got[n] for n in names] == pytest.approx(list(want), abs=1e-12)
    none = trees.importance(trees.tree_rows(spark, []), ["a", "b"]).collect()
    assert [r["importance"] for r in none] == [0.0, 0.0]


def plain_tree(x, y, w, depth):
    """Splits with the largest gain in weighted variance, at midpoints of neighbouring values; a function of a row."""
    mean = float(np.average(y, weights=w))

    def impurity(part):
        return float(np.average((y[part] - np.average(y[part], weights=w[part])) ** 2, weights=w[part])) * w[part].sum()

    best = None
    if depth:
        whole = impurity(np.ones(len(y), bool))
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                left = x[:, f] <= (low + high) / 2
                gain = whole - impurity(left) - impurity(~left)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, (low + high) / 2, left)
    if best is None:
        return lambda row: mean
    _, f, threshold, left = best
    below, above = plain_tree(x[left], y[left], w[left], depth - 1), plain_tree(x[~left], y[~left], w[~left], depth - 1)
    return lambda row: below(row) if row[f] <= threshold else above(row)


def plain_boosting(x, y, w, rounds, depth, rate, classes):
    """Margins after ``rounds`` trees: the first fits the label, the others the negative gradient of the loss so far."""
    target = 2 * y - 1 if classes else y
    first = plain_tree(x, target, w, depth)
    margin = np.array([first(row) for row in x])
    for _ in range(rounds - 1):
        slope = 4 * target / (1 + np.exp(2 * target * margin)) if classes else 2 * (target - margin)
        tree = plain_tree(x, slope, w, depth)
        margin += rate * np.array([tree(row) for row in x])
    return margin


def test_fits_equal_plain_boosting(spark):
    """Both learners as the reports configure them, on features with few values, where every split is tried."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import GBTRegressor

    from loomcart.plans import churn, clv

    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, (300, 4)).astype(float)
    y = 3 * x[:, 0] - x[:, 1] * x[:, 2] / 5 + rng.normal(size=300)
    label = (y + rng.normal(size=300) * 5 > np.median(y)).astype(float)
    weight = np.where(label > 0, 2.5, 1.0)
    rows = [(i, Vectors.dense(p), float(a), float(b), float(c)) for i, (p, a, b, c) in enumerate(zip(x, y, label, weight))]
    df = spark.createDataFrame(rows, ["i", "features", "spend", "churned", "weight"])
    spend = GBTRegressor(labelCol="spend", maxIter=6, maxDepth=clv.DEPTH, stepSize=clv.RATE, seed=clv.SEED).fit(df)
    got = [r["prediction"] for r in spend.transform(df).orderBy("i").collect()]
    assert got == pytest.approx(list(plain_boosting(x, y, np.ones(300), 6, clv.DEPTH, clv.RATE, False)), abs=1e-6)
    lapse = GBTClassifier(labelCol="churned", weightCol="weight", maxIter=6, maxDepth=churn.DEPTH, stepSize=churn.RATE, seed=churn.SEED).fit(df)
    got = [r["m"] for r in lapse.transform(df).orderBy("i").select(vector_to_array("rawPrediction")[1].alias("m")).collect()]
    assert got == pytest.approx(list(plain_boosting(x, label, weight, 6, churn.DEPTH, churn.RATE, True)), abs=1e-6)
