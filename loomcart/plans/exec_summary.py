"""The executive summary's six headline numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.functions.scalar import as_money, month_start, ratio
from loomcart.operators.order_values import completed, order_values
from loomcart.plans.growth import last_of
from loomcart.session import materialise
from loomcart.sources.star import Star


def exec_kpis(star: Star) -> DataFrame:
    """RFM-base customers and revenue, revenue per order, and the latest month with its growth.

    The fact tables are read once, into sums per customer and month; both halves start from those.
    """
    sums = materialise(
        order_values(completed(star.orders), star.lines)
        .groupBy("customer_id", month_start(F.col("order_date")).alias("month"))
        .agg(F.sum("order_value").alias("value"), F.count("order_id").alias("orders")),
        "customer-months",
    )
    latest = last_of(sums.groupBy("month").agg(F.round(F.sum("value"), 2).alias("revenue")))
    month = latest.select(F.struct(*latest.columns).alias("m")).scalar()
    per_customer = sums.groupBy("customer_id").agg(F.round(F.sum("value"), 2).alias("monetary"), F.sum("orders").alias("frequency"))
    return (
        per_customer.agg(
            F.count("customer_id").alias("customers"),
            F.sum("monetary").alias("revenue"),
            F.sum("frequency").alias("orders"),
        )
        .select(
            F.col("customers").alias("total_customers"),
            as_money(F.col("revenue")).alias("total_revenue"),
            F.round(ratio(F.col("revenue"), F.col("orders")), 2).alias("avg_order_value_proxy"),
            month.getField("revenue").alias("latest_month_revenue"),
            month.getField("mom_growth_pct").alias("latest_month_mom_growth_pct"),
            month.getField("yoy_growth_pct").alias("latest_month_yoy_growth_pct"),
        )
    )
