"""Order values: line totals summed per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETED = "Completed"


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == COMPLETED)


def order_values(orders: DataFrame, lines: DataFrame, keep_empty: bool = False, few: bool = False) -> DataFrame:
    """``orders`` plus ``order_value``.

    Lines are summed per order before the join, so at most one row per order is
    joined, however many lines a single order has. ``keep_empty`` keeps orders
    without lines, with a null value; without it they are dropped. ``few``
    says that ``orders`` are a small part: lines of others leave before the sum.
    """
    if few:
        lines = lines.join(orders.select("order_id"), "order_id", "left_semi")
    totals = lines.groupBy("order_id").agg(F.sum("line_total").alias("order_value"))
    return orders.join(totals, "order_id", "left" if keep_empty else "inner")


def gross_values(items: DataFrame) -> DataFrame:
    """List-price revenue per order: quantity times unit price, discounts ignored."""
    return items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("gross_value")
    )
