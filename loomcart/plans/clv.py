"""Forward 90-day spend from the first 90 days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.operators.encode import fit_encoder
from loomcart.operators.features import clv_features
from loomcart.operators.split import fit_rows, random_split
from loomcart.plans import trees
from loomcart.session import materialise
from loomcart.sources.sinks import metrics_frame
from loomcart.sources.star import Star

NUMBERS = ["orders_first90", "spend_first90", "avg_order_value_first90", "age"]
CATEGORIES = ["acquisition_channel", "country"]
TREES = 300
DEPTH = 3
RATE = 0.05
SEED = 42


@dataclass(frozen=True)
class ClvRun:
    scored: DataFrame
    names: list[str]
    model: GBTRegressionModel


def clv_split(star: Star) -> DataFrame:
    return random_split(clv_features(star))


def train_clv(star: Star, trees: int = TREES) -> ClvRun:
    """Fit on the whole train part; ``scored`` holds every eligible customer with its prediction."""
    table = materialise(clv_split(star), "clv")
    encoder = fit_encoder(table.where(~F.col("is_test")), NUMBERS, CATEGORIES)
    encoded = encoder.transform(table)
    learner = GBTRegressor(
        labelCol="spend_next90", maxIter=trees, maxDepth=DEPTH, stepSize=RATE, seed=SEED
    )
    train = encoded.where(~F.col("is_test")).select("customer_id", "features", "spend_next90")
    with fit_rows(train, "customer_id", limit=None) as rows:
        model = learner.fit(rows)
    return ClvRun(model.transform(encoded), encoder.names(), model)


def clv_predictions(run: ClvRun) -> DataFrame:
    return run.scored.select(
        "customer_id",
        "spend_first90",
        F.bround(F.col("prediction").cast("decimal(24,8)"), 2).cast("double").alias("predicted_clv_90d"),
    )


def clv_metrics(run: ClvRun) -> DataFrame:
    """Rows of both parts, mean absolute error and R2 on the test part."""
    test = run.scored.where("is_test").select("spend_next90", "prediction")
    rows = {r["is_test"]: r["count"] for r in run.scored.groupBy("is_test").count().collect()}
    scores = {
        name: RegressionEvaluator(labelCol="spend_next90", metricName=name).evaluate(test) for name in ("mae", "r2")
    }
    return metrics_frame(
        run.scored.sparkSession,
        "clv",
        {"train_rows": rows.get(False, 0), "test_rows": rows.get(True, 0), **scores},
    )


def clv_importance(run: ClvRun, top: int = 10) -> DataFrame:
    shares = trees.importance(trees.node_table(run.scored.sparkSession, run.model), run.names)
    return shares.orderBy(F.desc("importance"), "feature").limit(top)
