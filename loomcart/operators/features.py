"""Customer features from windows of days after signup."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.functions.scalar import ratio
from loomcart.operators.lookup import lookup
from loomcart.operators.order_values import completed, order_values
from loomcart.sources.star import Star

TRAITS = ["age", "acquisition_channel", "country"]


def eligible_customers(customers: DataFrame, tenure_days: int, as_of: datetime.date | None = None) -> DataFrame:
    """Customers who signed up at least ``tenure_days`` before the latest signup, or before ``as_of``."""
    latest = customers.agg(F.max("signup_date")).scalar() if as_of is None else F.lit(as_of)
    return customers.where(F.col("signup_date") <= F.date_sub(latest, tenure_days))


#: The last day after signup that a report asks for, and the days a customer must have been there for each report.
LAST_DAY = 270
CLV_TENURE, CHURN_TENURE = 181, 271
SUMS = ["orders", "valued", "spend", "web"]


def customer_history(star: Star, tenure_days: int = CLV_TENURE, last_day: int = LAST_DAY) -> DataFrame:
    """Eligible customers with completed orders: ``days``, sorted by day since signup, each with the sums up to it.

    Orders meet their customers and lose the other days before any line is summed. They are summed per customer and day
    first, so a customer with many orders is spread over days and arrives as ``last_day + 1`` rows at most.
    """
    eligible = eligible_customers(star.customers, tenure_days).select("customer_id", "signup_date", *TRAITS)
    orders = completed(star.orders).select("order_id", "customer_id", "order_date", "channel")
    placed = (
        lookup(orders, eligible, "customer_id", spread="order_id", how="inner")
        .withColumn("day", F.datediff("order_date", "signup_date"))
        .where(F.col("day").between(0, last_day))
    )
    daily = (
        order_values(placed, star.lines, keep_empty=True, few=True)
        .groupBy("customer_id", "signup_date", *TRAITS, "day")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("order_value").alias("valued"),
            F.coalesce(F.sum("order_value"), F.lit(0)).alias("spend"),
            F.count_if(F.col("channel") == "Web").alias("web"),
        )
    )
    so_far = Window.partitionBy("customer_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    summed = daily.withColumns({c: F.sum(c).over(so_far) for c in SUMS})
    return summed.groupBy("customer_id").agg(
        *[F.first(c).alias(c) for c in ("signup_date", *TRAITS)],
        F.array_sort(F.collect_list(F.struct("day", *SUMS))).alias("days"),
    )


def between_days(first: int, last: int, column: str) -> Column:
    """A sum over the days from ``first`` to ``last`` of a customer's history: what is reached by the one less what was
    reached before the other."""

    def reached(day: int) -> Column:
        return F.coalesce(F.try_element_at(F.filter("days", lambda d: d["day"] <= day), F.lit(-1))[column], F.lit(0))

    return reached(last) - reached(first - 1) if first > 0 else reached(last)


def clv_features(star: Star, history: DataFrame | None = None) -> DataFrame:
    """Days 0-90 as features, spend of days 91-180 as the label; buyers of days 0-90 only.

    A customer whose early orders are all without items gets an average of 0. ``history`` is that of ``customer_history``.
    """
    per_customer = (customer_history(star) if history is None else history).select(
        "customer_id",
        *TRAITS,
        between_days(0, 90, "orders").alias("orders_first90"),
        between_days(0, 90, "spend").cast("double").alias("spend_first90"),
        between_days(0, 90, "valued").alias("valued"),
        between_days(91, 180, "spend").cast("double").alias("spend_next90"),
    )
    return per_customer.where("orders_first90 > 0").select(
        "customer_id",
        "orders_first90",
        "spend_first90",
        F.coalesce(ratio(F.col("spend_first90"), F.col("valued")), F.lit(0.0)).alias("avg_order_value_first90"),
        *TRAITS,
        "spend_next90",
    )


def churn_features(star: Star, history: DataFrame | None = None) -> DataFrame:
    """Days 0-180 as features; churned means no order in days 181-270. Active customers only."""
    latest = star.customers.agg(F.max("signup_date")).scalar()
    old_enough = (customer_history(star, CHURN_TENURE) if history is None else history).where(
        F.col("signup_date") <= F.date_sub(latest, CHURN_TENURE)
    )
    per_customer = old_enough.select(
        "customer_id",
        *TRAITS,
        between_days(0, 180, "orders").alias("orders_0_180"),
        between_days(0, 180, "spend").cast("double").alias("spend_0_180"),
        between_days(0, 180, "valued").alias("valued"),
        between_days(0, 180, "web").alias("web"),
        between_days(181, 270, "orders").alias("orders_181_270"),
    )
    return per_customer.where("orders_0_180 > 0").select(
        "customer_id",
        *TRAITS,
        "orders_0_180",
        "spend_0_180",
        F.coalesce(ratio(F.col("spend_0_180"), F.col("valued")), F.lit(0.0)).alias("avg_order_value"),
        ratio(F.col("web"), F.col("orders_0_180")).alias("channel_web_share"),
        "orders_181_270",
        (F.col("orders_181_270") == 0).cast("int").alias("churned"),
    )


def eligible_buyers(star: Star, tenure_days: int = 181) -> DataFrame:
    """Eligible customers who placed a completed order at any time."""
    buyers = completed(star.orders).select("customer_id").distinct()
    return (
        eligible_customers(star.customers, tenure_days)
        .select("customer_id", "signup_date")
        .join(buyers, "customer_id", "left_semi")
    )


def churn_base_rate(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("customer_id").alias("active_customers"), F.round(F.avg("churned"), 6).alias("churn_rate")
    )
