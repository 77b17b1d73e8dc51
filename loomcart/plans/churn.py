"""Lapse risk after the first 180 days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.scalar import ratio
from loomcart.operators.encode import fit_encoder
from loomcart.operators.features import churn_features
from loomcart.operators.split import fit_rows, stratified_split
from loomcart.session import materialise
from loomcart.sources.sinks import metrics_frame
from loomcart.sources.star import Star

NUMBERS = ["age", "orders_0_180", "spend_0_180", "avg_order_value", "channel_web_share"]
CATEGORIES = ["acquisition_channel", "country"]
TREES = 300
DEPTH = 4
RATE = 0.05
SEED = 42
THRESHOLD = 0.5


@dataclass(frozen=True)
class ChurnRun:
    scored: DataFrame
    names: list[str]
    model: GBTClassificationModel


def churn_split(star: Star) -> DataFrame:
    return stratified_split(churn_features(star), "churned")


def churn_class_weight(split: DataFrame) -> DataFrame:
    """Stayed over churned customers in the train part: the weight of the churned class."""
    return (
        split.where(~F.col("is_test"))
        .agg(
            F.count_if(F.col("churned") == 0).alias("stayed"),
            F.count_if(F.col("churned") == 1).alias("churned"),
        )
        .select("stayed", "churned", F.round(ratio(F.col("stayed"), F.col("churned")), 6).alias("class_weight"))
    )


def train_churn(star: Star, trees: int = TREES) -> ChurnRun:
    """Fit on the whole class-weighted train part; ``scored`` holds every active customer."""
    table = materialise(churn_split(star), "churn")
    encoder = fit_encoder(table.where(~F.col("is_test")), NUMBERS, CATEGORIES)
    encoded = encoder.transform(table)
    balance = churn_class_weight(table).first()
    weight = balance["stayed"] / balance["churned"] if balance["stayed"] and balance["churned"] else 1.0
    train = encoded.where(~F.col("is_test")).select(
        "customer_id", "features", "churned", F.when(F.col("churned") == 1, weight).otherwise(1.0).alias("weight")
    )
    learner = GBTClassifier(
        labelCol="churned",
        weightCol="weight",
        maxIter=trees,
        maxDepth=DEPTH,
        stepSize=RATE,
        seed=SEED,
    )
    with fit_rows(train, "customer_id", limit=None) as rows:
        model = learner.fit(rows)
    scored = model.transform(encoded).withColumn("p", vector_to_array("probability")[1])
    return ChurnRun(scored, encoder.names(), model)


def churn_predictions(run: ChurnRun) -> DataFrame:
    """Every active customer with its risk; sort or limit as the reader needs."""
    return run.scored.select(
        "customer_id",
        F.bround(F.col("p").cast("decimal(12,10)"), 3).cast("double").alias("churn_probability"),
        "orders_0_180",
        "spend_0_180",
    )


def churn_risk_top(run: ChurnRun, n: int = 100) -> DataFrame:
    return churn_predictions(run).orderBy(F.desc("churn_probability"), "customer_id").limit(n)


def churn_metrics(run: ChurnRun) -> DataFrame:
    """Cohort size and base rate of all active customers, AUC on the test part."""
    base = run.scored.agg(F.count("customer_id").alias("n"), F.avg("churned").alias("rate")).first()
    auc = BinaryClassificationEvaluator(labelCol="churned", metricName="areaUnderROC", numBins=0).evaluate(
        run.scored.where("is_test").select("churned", "rawPrediction")
    )
    return metrics_frame(
        run.scored.sparkSession,
        "churn",
        {"active_customers": base["n"], "base_churn_rate": base["rate"], "auc_roc": auc},
    )


def churn_report_averages(run: ChurnRun, threshold: float = THRESHOLD) -> DataFrame:
    """Accuracy, and the averages of both classes' precision, recall and F1: plain and weighted by support."""
    classes = churn_class_report(run, threshold)
    support = F.sum("support").alias("support")
    scores = ("precision", "recall", "f1")
    right = F.round(ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")), 6)
    row = classes.agg(
        support,
        right.alias("accuracy"),
        *[F.round(F.avg(c), 6).alias(f"macro_{c}") for c in scores],
        *[F.round(ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")), 6).alias(f"weighted_{c}") for c in scores],
    )
    empty = F.lit(None).cast("double")

    def line(name: str, *values: Column) -> Column:
        return F.struct(F.lit(name).alias("average"), *[v.alias(c) for v, c in zip(values, scores)], F.col("support").alias("support"))

    averages = [line(k, *[F.col(f"{k}_{c}") for c in scores]) for k in ("macro", "weighted")]
    return row.select(F.inline(F.array(line("accuracy", empty, empty, F.col("accuracy")), *averages)))


def churn_class_report(run: ChurnRun, threshold: float = THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and support of both classes on the test part."""
    guess = (F.col("p") > threshold).cast("int")
    # Four counts at most; both classes always get a row.
    cells = run.scored.where("is_test").groupBy("churned", guess.alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    per_class = cells.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("class"), "churned", "guess", "n")
    actual, guessed = F.col("churned") == F.col("class"), F.col("guess") == F.col("class")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return (
        per_class.groupBy("class")
        .agg(total(actual & guessed).alias("hit"), total(guessed).alias("called"), total(actual).alias("support"))
        .withColumn("precision", F.coalesce(ratio(F.col("hit"), F.col("called")), F.lit(0.0)))
        .withColumn("recall", F.coalesce(ratio(F.col("hit"), F.col("support")), F.lit(0.0)))
        .select(
            F.col("class").alias("churned"),
            F.round("precision", 6).alias("precision"),
            F.round("recall", 6).alias("recall"),
            F.round(
                F.coalesce(
                    ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
                ),
                6,
            ).alias("f1"),
            "support",
        )
    )
