"""Writes the full set of result files for one star."""

from __future__ import annotations

from loomcart.plans import abtest, churn, clv, growth, segment
from loomcart.sources.sinks import write_csv, write_metrics
from loomcart.sources.star import Star


def write_outputs(star: Star, folder: str, clv_trees: int = clv.TREES, churn_trees: int = churn.TREES) -> None:
    """Segments and their profile, monthly growth, test results, both models' scores and metrics.

    Every table goes to a folder of CSV parts with a header, metrics to JSON.
    """
    segments = segment.segment_customers_by_kmeans(star)
    spend = clv.train_clv(star, clv_trees)
    lapse = churn.train_churn(star, churn_trees)
    tables = {
        "customer_segments": segment.kmeans_segments(segments),
        "segment_profile": segment.segment_profile(segments),
        "monthly_revenue": growth.revenue_growth(star),
        "ab_test_results": abtest.ab_summary(star).withColumnRenamed("significant_at_0_05", "significant_at_0.05"),
        "clv_predictions": clv.clv_predictions(spend),
        "churn_predictions": churn.churn_predictions(lapse).orderBy("churn_probability", ascending=False),
    }
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")
    write_metrics(clv.clv_metrics(spend), f"{folder}/clv_model_metrics")
    write_metrics(churn.churn_metrics(lapse), f"{folder}/churn_model_metrics")
