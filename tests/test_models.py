"""Invariants of the fitted models, and attributions against brute-force Shapley values."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta
from decimal import Decimal
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcart.operators import split
from loomcart.operators.encode import fit_encoder
from loomcart.operators.calendar import calendar_covering
from loomcart.plans import churn, clv, explain, kpi, segment
from loomcart.plans.outputs import write_outputs
from loomcart.sources.schemas import SCHEMAS
from loomcart.sources.star import Star


@pytest.fixture(scope="module")
def planted(spark) -> Star:
    """Web-only early buyers come back after day 180, others do not; spend repeats itself."""
    rng = random.Random(3)
    start = date(2023, 1, 1)
    customers, orders, items = [], [], []
    for c in range(240):
        signup = start + timedelta(days=rng.randrange(60))
        web = c % 2 == 0
        customers.append((c, signup, f"N{c % 3}", "F", 20 + c % 40, f"ch{c % 4}", "control"))
        size = rng.randrange(1, 50)
        days = [rng.randrange(90), rng.randrange(91, 181)] + ([rng.randrange(181, 271)] if web or rng.random() < 0.1 else [])
        for d in days:
            o = len(orders)
            orders.append((o, c, signup + timedelta(days=d), "Completed", "Web" if web else "Mobile App", "control", False, Decimal("0")))
            items.append((o, o, 1, 1, Decimal(size), Decimal(size)))
    customers.append((999, start + timedelta(days=400), "N0", "F", 20, "ch0", "control"))
    c, o, i = (
        spark.createDataFrame(r, SCHEMAS[t])
        for r, t in ((customers, "dim_customers"), (orders, "fact_orders"), (items, "fact_order_items"))
    )
    return Star(
        customers=lambda: c,
        products=lambda: spark.createDataFrame([], SCHEMAS["dim_products"]),
        dates=lambda: calendar_covering(o.selectExpr("order_date AS date")),
        orders=lambda: o,
        order_items=lambda: i,
    )


@pytest.fixture(scope="module")
def churn_run(planted):
    return churn.train_churn(planted, trees=5)


def test_churn_finds_the_planted_signal(churn_run):
    metrics = {r["metric"]: r["value"] for r in churn.churn_metrics(churn_run).collect()}
    assert metrics["active_customers"] == 240
    assert metrics["auc_roc"] > 0.8
    predictions = churn.churn_predictions(churn_run)
    assert predictions.where("churn_probability < 0 OR churn_probability > 1").isEmpty()
    assert predictions.count() == 240 == predictions.select("customer_id").distinct().count()


def test_auc_equals_the_share_of_ordered_pairs(churn_run):
    test = churn_run.scored.where("is_test").select("churned", "p").collect()
    gone, stayed = ([r["p"] for r in test if r["churned"] == label] for label in (1, 0))
    wins = sum((g > s) + 0.5 * (g == s) for g in gone for s in stayed)
    metrics = {r["metric"]: r["value"] for r in churn.churn_metrics(churn_run).collect()}
    assert metrics["auc_roc"] == pytest.approx(wins / (len(gone) * len(stayed)), abs=1e-9)


def test_churn_top_list_is_sorted(churn_run):
    risks = [(-r["churn_probability"], r["customer_id"]) for r in churn.churn_risk_top(churn_run, 20).collect()]
    assert len(risks) == 20 and risks == sorted(risks)


def test_class_report_adds_up(churn_run):
    report = {r["churned"]: r for r in churn.churn_class_report(churn_run).collect()}
    test = [(r["churned"], int(r["p"] > 0.5)) for r in churn_run.scored.where("is_test").collect()]
    for label in (0, 1):
        hit = sum(a == g == label for a, g in test)
        actual, called = sum(a == label for a, _ in test), sum(g == label for _, g in test)
        assert report[label]["support"] == actual
        assert report[label]["recall"] == pytest.approx(hit / actual, abs=1e-6)
        assert report[label]["precision"] == pytest.approx(hit / called if called else 0, abs=1e-6)


def test_encoder_drops_the_first_level(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "y"), (3, "c", "x")], "n int, k string, m string")
    encoder = fit_encoder(df, ["n"], ["k", "m"])
    assert encoder.names() == ["n", "k_is_b", "k_is_c", "m_is_y"]
    assert encoder.transform(df).where("k = 'a'").first()["features"].toArray().tolist() == [2.0, 0.0, 0.0, 1.0]


def test_encoder_takes_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (5, None), (3, "zz")], "n int, k string")
    encoder = fit_encoder(df, ["n"], ["k"])
    assert encoder.names() == ["n", "k_is_b", "k_is_zz"]
    rows = encoder.transform(df).collect()
    assert [r["features"].toArray().tolist() for r in rows] == [[1, 1, 0], [3, 0, 0], [5, 0, 0], [3, 0, 1]]


def test_models_train_on_missing_traits(spark, planted):
    gaps = planted.customers.withColumns(
        {c: F.when(F.col("customer_id") % 7 != i, F.col(c)) for i, c in enumerate(("country", "acquisition_channel", "age"))}
    )
    star = planted.with_tables(customers=lambda: gaps)
    assert churn.churn_predictions(churn.train_churn(star, trees=2)).count() == 240
    assert clv.clv_predictions(clv.train_clv(star, trees=2)).count() == 240


def test_clv_is_fitted_on_all_training_rows(planted, monkeypatch):
    fitted = []

    class Learner(clv.GBTRegressor):
        def fit(self, rows, params=None):
            fitted.append(rows.count())
            return super().fit(rows, params)

    monkeypatch.setattr(clv, "GBTRegressor", Learner)
    monkeypatch.setattr(split.fit_rows.__wrapped__, "__defaults__", (50, split.SEED))
    run = clv.train_clv(planted, trees=2)
    assert fitted == [run.scored.where("not is_test").count()]


def test_churn_metrics_come_from_a_fit_on_all_training_rows(planted, monkeypatch):
    fitted = []

    class Learner(churn.GBTClassifier):
        def fit(self, rows, params=None):
            fitted.append(tuple(rows.agg(F.count("features"), F.sum("churned"), F.sum("weight")).first()))
            return super().fit(rows, params)

    monkeypatch.setattr(churn, "GBTClassifier", Learner)
    monkeypatch.setattr(split.fit_rows.__wrapped__, "__defaults__", (50, split.SEED))
    run = churn.train_churn(planted, trees=2)
    rows, gone = run.scored.where("not is_test").agg(F.count("*"), F.sum("churned")).first()
    assert [f[:2] for f in fitted] == [(rows, gone)]
    assert fitted[0][2] == pytest.approx(2 * (rows - gone))  # both classes weigh the same
    assert churn.churn_metrics(run).where("metric = 'active_customers'").first()["value"] == 240


def test_explained_trees_have_seen_all_training_rows(spark, planted, monkeypatch):
    monkeypatch.setattr(split.fit_rows.__wrapped__, "__defaults__", (50, split.SEED))
    run = churn.train_churn(planted, trees=2)
    train = run.scored.where("not is_test").count()
    assert train > 100
    assert [nodes[0]["rawCount"] for nodes in explain.saved_nodes(spark, run.model).values()] == [train, train]


def test_clv_learns_and_ranks_features(planted):
    run = clv.train_clv(planted, trees=5)
    metrics = {r["metric"]: r["value"] for r in clv.clv_metrics(run).collect()}
    assert metrics["train_rows"] + metrics["test_rows"] == 240 == clv.clv_predictions(run).count()
    assert metrics["r2"] > 0.7
    test = [(r["spend_next90"], r["prediction"]) for r in run.scored.where("is_test").collect()]
    mean = sum(y for y, _ in test) / len(test)
    assert metrics["mae"] == pytest.approx(sum(abs(y - p) for y, p in test) / len(test))
    assert metrics["r2"] == pytest.approx(1 - sum((y - p) ** 2 for y, p in test) / sum((y - mean) ** 2 for y, _ in test))
    top = clv.clv_importance(run).collect()
    assert top[0]["feature"] in ("spend_first90", "avg_order_value_first90")
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)


def _expectation(nodes, node, x, known):
    """Value of a tree when only ``known`` features are followed and the rest averages over both children."""
    if node["leftChild"] < 0:
        return node["prediction"]
    split = node["split"]
    left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
    f = split["featureIndex"]
    if f in known:
        if split["numCategories"] < 0:
            goes_left = x[f] <= split["leftCategoriesOrThreshold"][0]
        else:
            goes_left = x[f] in split["leftCategoriesOrThreshold"]
        return _expectation(nodes, left if goes_left else right, x, known)
    return (
        left["rawCount"] * _expectation(nodes, left, x, known) + right["rawCount"] * _expectation(nodes, right, x, known)
    ) / node["rawCount"]


def test_attributions_equal_brute_force_shapley(spark, churn_run):
    trees = explain.saved_nodes(spark, churn_run.model)
    weights = churn_run.model.treeWeights
    used = sorted({n["split"]["featureIndex"] for nodes in trees.values() for n in nodes.values() if n["leftChild"] >= 0})
    assert 1 < len(used) <= 10

    def value(x, known):
        return sum(weights[t] * _expectation(nodes, nodes[0], x, known) for t, nodes in trees.items())

    explained = explain.explain_margin(churn_run, churn_run.scored).limit(3).collect()
    features = {r["customer_id"]: r["features"].toArray() for r in churn_run.scored.collect()}
    for row in explained:
        x = features[row["customer_id"]]
        for f in used:
            others = [u for u in used if u != f]
            brute = sum(
                math.factorial(k) * math.factorial(len(used) - 1 - k) / math.factorial(len(used)) * (value(x, {*s, f}) - value(x, set(s)))
                for k in range(len(used))
                for s in combinations(others, k)
            )
            assert row["phi"][f] == pytest.approx(brute, abs=1e-9)


def test_attributions_sum_to_the_margin(spark, churn_run):
    explained = explain.explain_margin(churn_run, churn_run.scored)
    gap = explained.select(F.abs(F.col("margin") - F.col("base") - F.aggregate("phi", F.lit(0.0), lambda a, b: a + b)).alias("gap"))
    assert gap.agg(F.max("gap")).first()[0] < 1e-9
    assert explained.count() == 240
    top = explain.churn_explain(churn_run).collect()
    assert len(top) == min(10, len(churn_run.names)) and top[0]["feature"] == "channel_web_share"


def test_inertia_falls_with_k_and_everyone_gets_a_cluster(spark, planted):
    elbow = [r["inertia"] for r in segment.kmeans_elbow(planted, ks=[2, 3, 4], starts=3).orderBy("k").collect()]
    assert elbow == sorted(elbow, reverse=True)
    run = segment.segment_customers_by_kmeans(planted, starts=2)
    out = segment.kmeans_segments(run)
    assert out.count() == 240 == out.select("customer_id").distinct().count()
    assert out.where("segment_label IS NULL").isEmpty()
    profile = segment.segment_profile(run).collect()
    assert [r["segment_label"] for r in profile] == segment.LABELS
    assert sum(r["customers"] for r in profile) == 240
    breakdown = kpi.segment_breakdown(run.customers, by="segment_label").collect()
    assert {r["segment_label"] for r in breakdown} == set(segment.LABELS)
    assert sum(r["pct_of_base"] for r in breakdown) == pytest.approx(1, abs=0.003)


def test_nearest_centroid_matches_numpy_and_breaks_ties_by_key(spark):
    rng = np.random.default_rng(5)
    points = [(i, *map(float, rng.normal(size=3))) for i in range(50)]
    centres = [(k, *map(float, rng.normal(size=3))) for k in range(4)]
    schema = "id int, " + ", ".join(f"{c} double" for c in segment.SCALED)
    c = spark.createDataFrame([*centres, (9, *centres[0][1:])], schema.replace("id", "key", 1))
    got = {r["id"]: r["nearest"] for r in segment.nearest_centroid(spark.createDataFrame(points, schema), c, "key").collect()}
    for i, *p in points:
        want = min(centres, key=lambda k: (sum((a - b) ** 2 for a, b in zip(p, k[1:])), k[0]))[0]
        assert got[i] == want


def test_all_outputs_are_written(spark, planted, tmp_path):
    write_outputs(planted, str(tmp_path), clv_trees=2, churn_trees=2)
    rows = {
        name: spark.read.option("header", True).csv(f"{tmp_path}/{name}").count()
        for name in ("customer_segments", "segment_profile", "ab_test_results", "clv_predictions", "churn_predictions")
    }
    assert rows == {
        "customer_segments": 240, "segment_profile": 5, "ab_test_results": 3, "clv_predictions": 240, "churn_predictions": 240,
    }
    for name in ("clv_model_metrics", "churn_model_metrics"):
        assert {"model", "metric", "value"} == set(spark.read.json(f"{tmp_path}/{name}").columns)
    assert "mom_growth_pct" in spark.read.option("header", True).csv(f"{tmp_path}/monthly_revenue").columns


def test_a_fit_on_many_rows_has_few_tasks():
    """Every round starts its tasks several times, so their number stays that of 300,000 rows until 250,000 rows are in each."""
    assert [split.fit_tasks(n) for n in (0, 1, 25_000, 25_001, 200_000, 300_000)] == [1, 1, 1, 2, 8, 12]
    assert [split.fit_tasks(n) for n in (900_000, 3_000_000, 3_000_001, 30_000_000)] == [12, 12, 13, 120]


def test_the_whole_train_part_is_dealt_to_the_tasks_of_a_fit(spark, monkeypatch):
    monkeypatch.setattr(split, "FIT_ROWS_PER_TASK", 10)
    monkeypatch.setattr(split, "FIT_ROWS_PER_TASK_AT_MOST", 100)
    train = spark.range(1000).withColumnRenamed("id", "customer_id").withColumn("x", F.col("customer_id"))
    with split.fit_rows(train, "customer_id", limit=None) as rows:
        assert rows.rdd.getNumPartitions() == split.FIT_TASKS
        assert rows.agg(F.count("x"), F.sum("x")).first()[:] == (1000, 499500)
