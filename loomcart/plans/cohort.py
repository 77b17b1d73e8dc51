"""Signup-month cohorts and their activity in the months that follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.functions.scalar import month_label, month_start, months_apart
from loomcart.operators.bitmaps import bitmaps, distinct_count
from loomcart.operators.order_values import completed
from loomcart.sources.star import Star

LAST_INDEX = 12


def cohort_activity(star: Star, last_index: int = LAST_INDEX, traits: Sequence[str] = ()) -> DataFrame:
    """One row per customer and active month, 0..``last_index`` months after signup, with the customer's ``traits``.

    Orders shrink to distinct (customer, month) before they meet the customers,
    so a customer contributes at most one row per calendar month to the join.
    """
    months = (
        completed(star.orders)
        .select("customer_id", month_start(F.col("order_date")).alias("order_month"))
        .distinct()
    )
    cohorts = star.customers.select("customer_id", month_start(F.col("signup_date")).alias("cohort"), *traits)
    return (
        months.join(cohorts, "customer_id")
        .withColumn("month_index", months_apart(F.col("order_month"), F.col("cohort")))
        .where(F.col("month_index").between(0, last_index))
    )


def _active(star: Star) -> DataFrame:
    # Rows are distinct per customer and month, so a plain count is the distinct count.
    return cohort_activity(star).groupBy("cohort", "month_index").agg(F.count("customer_id").alias("active_customers"))


def cohort_retention(star: Star) -> DataFrame:
    """Active share of the whole cohort, buyers or not."""
    sizes = (
        star.customers.groupBy(month_start(F.col("signup_date")).alias("cohort"))
        .agg(F.count("customer_id").alias("cohort_customers"))
    )
    return (
        _active(star)
        .join(sizes, "cohort")  # both sides hold one row per month (and index) by now
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            "month_index",
            "active_customers",
            "cohort_customers",
            F.round(100.0 * F.col("active_customers") / F.col("cohort_customers"), 1).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_index")
    )


def activity_bitmaps(star: Star) -> DataFrame:
    """Active customers as bitmaps by cohort, month index and acquisition channel; any coarser count comes from these."""
    cells = ["cohort", "month_index", "acquisition_channel"]
    return bitmaps(cohort_activity(star, traits=["acquisition_channel"]), cells, "customer_id")


def cohort_heatmap(star: Star, maps: DataFrame | None = None) -> DataFrame:
    """Crosstab of active customers, months without activity as 0. ``maps`` is that of ``activity_bitmaps``."""
    indexes = list(range(LAST_INDEX + 1))
    cells = distinct_count(activity_bitmaps(star) if maps is None else maps, ["cohort", "month_index"], "active_customers")
    wide = (
        cells.groupBy(month_label(F.col("cohort")).alias("cohort_month"))
        .pivot("month_index", indexes)
        .agg(F.sum("active_customers"))
        .fillna(0)
    )
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"m{i}") for i in indexes]).orderBy("cohort_month")


def active_customers(star: Star, maps: DataFrame | None = None) -> DataFrame:
    """Customers active in any month since signup, by acquisition channel and, under a null channel, of all."""
    maps = activity_bitmaps(star) if maps is None else maps
    every = distinct_count(maps, [], "active_customers").select(F.lit(None).cast("string").alias("acquisition_channel"), "active_customers")
    return distinct_count(maps, ["acquisition_channel"], "active_customers").unionByName(every)


def cohort_pct_of_total(star: Star) -> DataFrame:
    """Each cell as a share of its cohort's row total."""
    row = Window.partitionBy("cohort")
    return _active(star).select(
        month_label(F.col("cohort")).alias("cohort_month"),
        "month_index",
        "active_customers",
        F.round(F.col("active_customers") / F.sum("active_customers").over(row), 6).alias("pct_of_total"),
    )
