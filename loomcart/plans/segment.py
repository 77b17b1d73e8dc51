"""K-means segments on scaled RFM features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.operators import kmeans
from loomcart.plans.rfm import rfm_segments
from loomcart.session import materialise
from loomcart.sources.star import Star

# Labels by falling mean monetary value.
LABELS = ["VIP / Champions", "Loyal Regulars", "Promising", "At Risk", "Dormant / Lost"]
K_RANGE = range(2, 9)
STARTS = 10
SEED = 42
MAX_ITERATIONS = 300
SCALED = ["recency_scaled", "frequency_scaled", "monetary_scaled"]


def scale_rfm(rfm: DataFrame) -> DataFrame:
    """Log of frequency and monetary, then mean 0 and population deviation 1 per column.

    A constant column is centred but not divided. The moments are one row, read
    ahead: give a written-out frame, so that the fact tables are not scanned twice.
    """
    logged = rfm.withColumns(
        {
            "recency_scaled": F.col("recency_days").cast("double"),
            "frequency_scaled": F.log1p(F.col("frequency").cast("double")),
            "monetary_scaled": F.log1p(F.col("monetary").cast("double")),
        }
    )
    moments = logged.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in SCALED], *[F.stddev_pop(c).alias(f"{c}_std") for c in SCALED]
    ).first()
    return logged.withColumns(
        {c: (F.col(c) - F.lit(moments[f"{c}_mean"])) / F.lit(moments[f"{c}_std"] or 1.0) for c in SCALED}
    )


def fit_kmeans_range(
    points: DataFrame, ks: Sequence[int], starts: int = STARTS, seed: int = SEED
) -> dict[int, tuple[np.ndarray, float]]:
    """Centroids and inertia of the best of ``starts`` for every k; all runs share the passes over the points."""
    return kmeans.fit_many(points, SCALED, ks, starts, seed, MAX_ITERATIONS)


def scaled_customers(star: Star) -> DataFrame:
    """RFM rows with their scaled point, written out for what reads them again."""
    return materialise(scale_rfm(materialise(rfm_segments(star), "rfm")), "points")


def kmeans_elbow(star: Star, ks: Sequence[int] = K_RANGE, starts: int = STARTS) -> DataFrame:
    """Inertia of the best start for every k."""
    models = fit_kmeans_range(scaled_customers(star).select(*SCALED), ks, starts)
    rows = [(k, inertia) for k, (_, inertia) in models.items()]
    return star.orders.sparkSession.createDataFrame(rows, "k int, inertia double")


def segment_step(star: Star) -> DataFrame:
    """One K-means step from the means of the rule-based segments: members, inertia and the next centroids."""
    points = scaled_customers(star)
    begin = segment_centroids(points).orderBy("rfm_segment").collect()  # a row for each segment
    names = F.array(*[F.lit(r["rfm_segment"]) for r in begin])
    step = kmeans.kmeans_step(points, SCALED, np.array([[r[c] for c in SCALED] for r in begin]).reshape(-1, len(SCALED)))
    return step.select(
        F.get(names, F.col("cluster").cast("int")).alias("rfm_segment"),
        F.col("n").alias("customers"),
        F.round("inertia", 6).alias("inertia"),
        *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in SCALED],
    )


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary value (one decimal, half-even) and size per cluster."""

    def mean(c: str) -> Column:
        # Clusters number k, and sums are exact: the mean is rounded as a decimal.
        return F.bround(F.avg(F.col(c).cast("decimal(18,2)")), 1).cast("double").alias(c)

    return clustered.groupBy("cluster").agg(
        mean("recency_days"), mean("frequency"), mean("monetary"), F.count("customer_id").alias("customers")
    )


def label_clusters(clustered: DataFrame, k: int, labels: Sequence[str] = LABELS) -> DataFrame:
    """``segment_label`` by rank of the cluster's mean monetary value."""
    if k != len(labels):
        raise ValueError(f"{k} clusters need {k} labels, got {len(labels)}")
    rank = F.row_number().over(Window.orderBy(F.desc("monetary"), "cluster"))  # k rows
    named = cluster_profile(clustered).select(
        "cluster", F.element_at(F.array(*[F.lit(x) for x in labels]), rank).alias("segment_label")
    )
    return clustered.join(F.broadcast(named), "cluster")  # k rows, one per label


@dataclass(frozen=True)
class Segmentation:
    customers: DataFrame
    centroids: np.ndarray


def segment_customers_by_kmeans(star: Star, k: int = len(LABELS), starts: int = STARTS) -> Segmentation:
    points = scaled_customers(star)
    centroids, _ = fit_kmeans_range(points.select(*SCALED), [k], starts).get(k, (np.empty((0, len(SCALED))), 0.0))
    rows = [(i, *map(float, c)) for i, c in enumerate(centroids)]
    known = points.sparkSession.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in SCALED))
    clustered = nearest_centroid(points, known, "cluster").withColumnRenamed("nearest", "cluster")
    return Segmentation(label_clusters(clustered, k), centroids)


RFM_COLUMNS = [
    "customer_id",
    "recency_days",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "rfm_total",
    "rfm_segment",
]


def kmeans_segments(run: Segmentation) -> DataFrame:
    return run.customers.select(*RFM_COLUMNS, "cluster", "segment_label")


def segment_profile(run: Segmentation) -> DataFrame:
    profile = cluster_profile(run.customers)
    labels = run.customers.select("cluster", "segment_label").distinct()
    return profile.join(labels, "cluster").orderBy(F.desc("monetary"))


def nearest_centroid(points: DataFrame, centroids: DataFrame, key: str) -> DataFrame:
    """Add ``nearest``: the ``key`` of the closest row of ``centroids``, the smallest key among equals.

    ``centroids`` has one row per cluster or segment, with the same scaled columns; they travel as one array.
    Without centroids the result is null.
    """
    named = F.struct(F.col(key).alias("key"), *[F.col(c).alias(c) for c in SCALED])
    known = centroids.agg(F.collect_list(named)).scalar()

    def distance(c: Column) -> Column:
        total = sum((F.pow(F.col(name) - c[name], 2.0) for name in SCALED), F.lit(0.0))
        return F.struct(total.alias("distance"), c["key"].alias("key"))

    return (
        points.withColumn("_known", known)
        .withColumn("nearest", F.array_min(F.transform("_known", distance)).getField("key"))
        .drop("_known")
    )


def segment_centroids(scaled: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Mean scaled point of every rule-based segment."""
    return scaled.groupBy(by).agg(*[F.round(F.avg(c), 6).alias(c) for c in SCALED])
