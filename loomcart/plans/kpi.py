"""BI measures and the datasets behind the dashboard charts."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.functions.scalar import as_money, ratio
from loomcart.operators.lookup import lookup
from loomcart.operators.order_values import COMPLETED, completed, gross_values, order_values
from loomcart.sources.star import Star


def kpi_cards(star: Star) -> DataFrame:
    """Gross revenue, its completed part, orders, completed revenue per order, customers.

    The average divides completed revenue by the orders of every status.
    """
    status = star.orders.select("order_id", "order_status")
    is_completed = F.col("order_status") == COMPLETED
    revenue = (
        gross_values(star.order_items)
        .join(status, "order_id", "left")
        .agg(
            F.sum("gross_value").alias("total"),
            F.coalesce(F.sum(F.when(is_completed, F.col("gross_value"))), F.lit(0)).alias("done"),
        )
    )
    orders = star.orders.agg(F.countDistinct("order_id")).scalar()
    customers = star.customers.agg(F.countDistinct("customer_id")).scalar()
    return revenue.select(
        as_money(F.col("total")).alias("total_revenue"),
        as_money(F.col("done")).alias("completed_revenue"),
        orders.alias("total_orders"),
        F.round(ratio(F.col("done"), orders), 4).alias("average_order_value"),
        customers.alias("total_customers"),
    )


def apply_slicers(
    star: Star,
    countries: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    first_day: datetime.date | None = None,
    last_day: datetime.date | None = None,
    signup_from: datetime.date | None = None,
    signup_to: datetime.date | None = None,
) -> Star:
    """Restrict a star to customers and order dates; every report runs on the result.

    Items keep only those of the remaining orders.
    """
    customers, orders = star.customers, star.orders
    if countries is not None:
        customers = customers.where(F.col("country").isin(list(countries)))
    if channels is not None:
        customers = customers.where(F.col("acquisition_channel").isin(list(channels)))
    if signup_from is not None:
        customers = customers.where(F.col("signup_date") >= F.lit(signup_from))
    if signup_to is not None:
        customers = customers.where(F.col("signup_date") <= F.lit(signup_to))
    if first_day is not None:
        orders = orders.where(F.col("order_date") >= F.lit(first_day))
    if last_day is not None:
        orders = orders.where(F.col("order_date") <= F.lit(last_day))
    if customers is not star.customers:
        # customer_id is unique, so the inner lookup acts as a semi-join that tolerates hot customers.
        orders = lookup(orders, customers.select("customer_id"), "customer_id", spread="order_id", how="inner")
    orders = orders.select(star.orders.columns)
    kept = orders.select("order_id")

    def of_orders(items: DataFrame) -> DataFrame:
        found = lookup(items, kept, "order_id", spread="product_id", how="inner", keys_from=star.lines)
        return found.select(items.columns)

    return star.with_tables(
        customers=lambda: customers,
        orders=lambda: orders,
        order_items=lambda: of_orders(star.order_items),
        lines=lambda: of_orders(star.lines),
    )


def repeat_purchase_rate(star: Star) -> DataFrame:
    """Customers with more than one order of any status over all customers, buyers or not."""
    customers = star.customers.agg(F.countDistinct("customer_id")).scalar()
    return (
        star.orders.groupBy("customer_id")
        .agg(F.count("order_id").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("repeat_customers"))
        .select(
            "repeat_customers",
            customers.alias("total_customers"),
            F.round(ratio(F.col("repeat_customers"), customers), 6).alias("repeat_purchase_rate"),
        )
    )


def filtered_measure(star: Star) -> DataFrame:
    """Gross revenue per channel, next to the same measure filtered to completed orders; items of unknown orders have a
    null channel."""
    orders = star.orders.select("order_id", "channel", "order_status")
    value = F.col("gross_value")
    return (
        gross_values(star.order_items)
        .join(orders, "order_id", "left")
        .groupBy("channel")
        .agg(
            F.sum(value).alias("total"),
            F.coalesce(F.sum(F.when(F.col("order_status") == COMPLETED, value)), F.lit(0)).alias("done"),
        )
        .select(
            "channel",
            as_money(F.col("total")).alias("total_revenue"),
            as_money(F.col("done")).alias("completed_revenue"),
            F.round(ratio(F.col("done"), F.col("total")), 6).alias("completed_share"),
        )
    )


def revenue_by_category(star: Star) -> DataFrame:
    """Gross and net revenue per product category; items of unknown products have a null category.

    Items are summed per product first: a best-seller joins as a single row.
    """
    per_product = star.order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("gross"),
        F.sum("line_total").alias("net"),
    )
    return (
        per_product.join(star.products.select("product_id", "category"), "product_id", "left")
        .groupBy("category")
        .agg(
            F.sum("units").alias("units"),
            as_money(F.sum("gross")).alias("gross_revenue"),
            as_money(F.sum("net")).alias("net_revenue"),
        )
    )


def star_revenue(star: Star) -> DataFrame:
    """Net completed revenue by country, category, year and weekend: all four relationships.

    Unknown customers, products and dates have null attributes. Lines meet their completed order, the others leave, and then
    their product; only days are summed, so no task holds a sum for each of its orders.
    """
    orders = lookup(
        completed(star.orders).select("order_id", "customer_id", "order_date"),
        star.customers.select("customer_id", "country"),
        "customer_id",
        spread="order_id",
    ).drop("customer_id")
    sold = star.lines.select("order_id", "product_id", "quantity", "line_total").join(orders, "order_id")
    daily = (
        lookup(sold, star.products.select("product_id", "category"), "product_id", spread="order_id", keys_from=star.lines)
        .groupBy("country", "category", "order_date")
        .agg(F.sum("line_total").alias("net"), F.sum("quantity").alias("units"))
    )
    return (
        daily.join(star.dates, daily["order_date"] == star.dates["date"], "left")
        .groupBy("country", "category", "year", "is_weekend")
        .agg(as_money(F.sum("net")).alias("net_revenue"), F.sum("units").alias("units"))
    )


def web_share(star: Star) -> DataFrame:
    """Share of a customer's completed orders placed on the web."""
    return (
        completed(star.orders)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.round(F.avg((F.col("channel") == "Web").cast("double")), 6).alias("web_share"),
        )
    )


def orders_without_items(star: Star) -> DataFrame:
    """Orders that have no line, per status."""
    with_lines = star.lines.select("order_id").distinct()
    return (
        star.orders.join(with_lines, "order_id", "left_anti")
        .groupBy("order_status")
        .agg(F.count("order_id").alias("orders"))
    )


def completed_values(star: Star) -> DataFrame:
    return order_values(completed(star.orders), star.lines).select(
        "order_id", "customer_id", "order_date", as_money(F.col("order_value")).alias("order_value")
    )


# --- Segment datasets: any frame with customer_id, recency_days, monetary and a segment column ---


def _share(column: str) -> Column:
    # Runs on one row per segment.
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ratio(F.col(column), F.sum(column).over(everything))


def segment_customers(segments: DataFrame, by: str = "rfm_segment") -> DataFrame:
    return segments.groupBy(by).agg(F.count("customer_id").alias("customers"))


def segment_revenue(segments: DataFrame, by: str = "rfm_segment") -> DataFrame:
    return segments.groupBy(by).agg(as_money(F.sum("monetary")).alias("revenue"))


def segment_share(segments: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Each segment's share of customers and of revenue."""
    return (
        segments.groupBy(by)
        .agg(F.count("customer_id").alias("customers"), F.sum("monetary").alias("revenue"))
        .select(
            by,
            F.round(_share("customers"), 6).alias("customer_share"),
            F.round(_share("revenue"), 6).alias("revenue_share"),
        )
    )


def segment_breakdown(segments: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Count, share of base, revenue, average monetary value and recency per segment."""
    return (
        segments.groupBy(by)
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("monetary").alias("revenue"),
            F.sum("recency_days").alias("days"),
        )
        .select(
            by,
            "customers",
            F.round(_share("customers"), 3).alias("pct_of_base"),
            as_money(F.col("revenue")).alias("total_revenue"),
            F.round(ratio(F.col("revenue"), F.col("customers")), 0).alias("avg_monetary"),
            F.round(ratio(F.col("days"), F.col("customers")), 1).alias("avg_recency_days"),
        )
    )


def segment_drill(segments: DataFrame, segment: str, by: str = "rfm_segment") -> DataFrame:
    """The customers behind one segment."""
    return segments.where(F.col(by) == segment).select(
        "customer_id", "recency_days", "frequency", F.col("monetary").cast("double").alias("monetary")
    )
