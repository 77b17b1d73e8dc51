"""Recency, frequency and monetary value per customer, scores and segments."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.operators.order_values import completed, order_values
from loomcart.operators.ranks import with_ntiles
from loomcart.sources.star import Star

# Segment names are fixed values.
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
NEW = "New Customers"
AT_RISK = "At Risk"
LOST = "Lost"
OTHER = "Needs Attention"


def rfm_raw(star: Star, as_of: datetime.date | None = None) -> DataFrame:
    """One row per customer with a completed, non-empty order.

    Recency counts from the latest such order of anyone, unless ``as_of`` is given. Order ids must be unique, which
    ``dq_primary_key`` reports; a repeated id would count as often as it occurs.
    """
    values = order_values(completed(star.orders), star.lines)
    per_customer = values.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),  # order_id is the key: no distinct needed
        F.sum("order_value").alias("monetary"),
    )
    if as_of is not None:
        anchor = F.lit(as_of)
    else:
        # The subquery asks for every column, so that both uses of the customer
        # aggregate stay the same plan and the shuffle below it is reused.
        base = per_customer.agg(
            F.max("last_order_date").alias("latest"),
            F.count("customer_id").alias("customers"),
            F.sum("frequency").alias("orders"),
            F.sum("monetary").alias("revenue"),
        )
        anchor = base.select(F.struct("latest", "customers", "orders", "revenue").alias("base")).scalar().getField("latest")
    return per_customer.select(
        "customer_id",
        "last_order_date",
        F.datediff(anchor, "last_order_date").alias("recency_days"),
        "frequency",
        F.round("monetary", 2).alias("monetary"),
    )


def segment_of(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPIONS)
        .when((r >= 3) & (f >= 3), LOYAL)
        .when((r >= 4) & (f <= 2), NEW)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r <= 2) & (f <= 2) & (m <= 2), LOST)
        .otherwise(OTHER)
    )


def rfm_scores(star: Star, as_of: datetime.date | None = None) -> DataFrame:
    """Quintile scores 1-5; a smaller recency scores higher."""
    scored = with_ntiles(
        rfm_raw(star, as_of).drop("last_order_date"),
        5,
        {"_r": "recency_days", "f_score": "frequency", "m_score": "monetary"},
        key="customer_id",
    )
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        "monetary",
        (6 - F.col("_r")).alias("r_score"),
        "f_score",
        "m_score",
    )


def rfm_segments(star: Star, as_of: datetime.date | None = None) -> DataFrame:
    """Scores, their sum and the segment name. Sorting is left to the report's reader."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return rfm_scores(star, as_of).withColumns(
        {"rfm_total": r + f + m, "rfm_segment": segment_of(r, f, m)}
    )


def top_customers(star: Star, n: int = 100) -> DataFrame:
    return rfm_raw(star).orderBy(F.desc("monetary"), "customer_id").limit(n)
