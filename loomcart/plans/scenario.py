"""What-if grid for promotion discounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.functions.scalar import as_money, ratio
from loomcart.plans.abtest import CONTROL, TREATMENT, group_moments
from loomcart.sources.star import Star

# The scenario table's discounts and the assumed conversion lift per discount point.
DISCOUNTS = [0.00, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30]
FINE_DISCOUNTS = [i / 100 for i in range(31)]
LIFT_PER_POINT = 0.004


def promo_assumptions(star: Star, lift_per_point: float = LIFT_PER_POINT) -> DataFrame:
    """One row of inputs measured on the data.

    Customers reached are those of the treatment group; conversion and order
    value are the control group's; margin is what product cost leaves of list revenue.
    """
    group = F.col("ab_test_group")
    sold = star.lines.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    margin = (
        sold.join(star.products.select("product_id", "unit_cost", "unit_price"), "product_id")
        .agg(
            F.sum(F.col("units") * F.col("unit_cost")).alias("cost"),
            F.sum(F.col("units") * F.col("unit_price")).alias("list"),
        )
        .select(1 - ratio(F.col("cost"), F.col("list")))
        .scalar()
    )
    return (
        group_moments(star)
        .agg(
            F.max(F.when(group == TREATMENT, F.col("customers"))).alias("reached"),
            F.max(F.when(group == CONTROL, F.col("rate"))).alias("conversion"),
            F.max(F.when(group == CONTROL, F.col("order_mean"))).alias("order_value"),
        )
        .select(
            "reached",
            F.round("conversion", 3).alias("conversion"),
            F.round("order_value", 0).alias("order_value"),
            F.lit(lift_per_point).alias("lift_per_point"),
            F.round(margin, 2).alias("margin"),
        )
    )


def promo_scenario(assumptions: DataFrame, discounts: Sequence[float] = DISCOUNTS) -> DataFrame:
    """Each row of ``assumptions`` under each discount, in exact decimals.

    The projected conversion is not capped at 1, and the discount is taken off
    the margin rate as well as off the price.
    """
    offered = F.array(*[F.lit(d).cast("decimal(5,2)") for d in discounts])
    d = F.col("discount")
    return (
        assumptions.select(
            F.col("reached").cast("bigint").alias("reached"),
            *[F.col(c).cast("decimal(9,6)").alias(c) for c in ("conversion", "lift_per_point", "margin")],
            F.col("order_value").cast("decimal(15,2)").alias("order_value"),
            F.explode(offered).alias("discount"),
        )
        .withColumn("rate", F.col("conversion") + F.col("lift_per_point") * d * 100)
        .withColumn("buyers", F.round(F.col("reached") * F.col("rate"), 0).cast("bigint"))
        .withColumn("price", F.col("order_value") * (1 - d))
        .withColumn("revenue", F.col("buyers") * F.col("price"))
        .select(
            d.cast("double").alias("discount"),
            F.round("rate", 6).cast("double").alias("projected_conversion"),
            F.col("buyers").alias("customers_converted"),
            F.col("price").cast("double").alias("effective_order_value"),
            as_money(F.col("revenue")).alias("projected_revenue"),
            as_money(F.col("revenue") * F.greatest(F.col("margin") - d, F.lit(0))).alias("projected_margin"),
        )
    )


def promo_best_discount(assumptions: DataFrame, discounts: Sequence[float] = FINE_DISCOUNTS) -> DataFrame:
    """The discount with the highest projected margin; the smallest one among equals."""
    by = F.struct(F.col("projected_margin"), -F.col("discount"))
    best = F.max_by(F.struct("discount", "projected_margin", "projected_revenue"), by)
    return promo_scenario(assumptions, discounts).agg(best.alias("best")).select("best.*")
