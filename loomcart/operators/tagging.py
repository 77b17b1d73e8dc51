"""Promotion tagging of orders and the discounted line totals that follow from it."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.operators.lookup import lookup

DISCOUNT = Decimal("0.15")


def tag_orders(
    orders: DataFrame,
    customers: DataFrame,
    first_day: datetime.date,
    last_day: datetime.date,
    discount: Decimal = DISCOUNT,
) -> DataFrame:
    """Test group from the customer, window flag from the date, discount where both apply."""
    bare = orders.drop("ab_test_group", "in_ab_test", "discount_pct")
    grouped = lookup(bare, customers.select("customer_id", "ab_test_group"), "customer_id", spread="order_id")
    in_window = F.col("order_date").between(F.lit(first_day), F.lit(last_day))
    treated = in_window & (F.col("ab_test_group") == "treatment")
    rate = F.when(treated, F.lit(discount).cast("decimal(5,2)")).otherwise(F.lit(0).cast("decimal(5,2)"))
    return grouped.withColumns({"in_ab_test": in_window, "discount_pct": rate})


def line_totals(
    lines: DataFrame, orders: DataFrame, products: DataFrame, spend_factor: DataFrame | None = None
) -> DataFrame:
    """List price x quantity x (1 - order discount), half-even to cents.

    ``spend_factor`` (customer_id, factor) scales a customer's prices; without it the factor is 1. Every line stays;
    one of an unknown product or order has no total.
    """
    if spend_factor is None:
        rates = orders.select("order_id", "discount_pct", F.lit(1).cast("decimal(9,4)").alias("factor"))
    else:
        rates = lookup(
            orders.select("order_id", "customer_id", "discount_pct"),
            spend_factor.select("customer_id", F.col("factor").cast("decimal(9,4)").alias("factor")),
            "customer_id",
            spread="order_id",
        ).select("order_id", "discount_pct", F.coalesce("factor", F.lit(1)).alias("factor"))
    bare = lines.select("order_item_id", "order_id", "product_id", "quantity")
    priced = lookup(bare, products.select("product_id", "unit_price"), "product_id", spread="order_id")
    full = lookup(priced, rates, "order_id", spread="product_id", keys_from=bare)
    amount = (
        F.col("unit_price") * F.col("quantity") * F.col("factor").cast("decimal(9,4)") * (1 - F.col("discount_pct"))
    )
    return full.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_pct",
        F.bround(amount, 2).alias("line_total"),
    )
