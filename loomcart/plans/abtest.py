"""Readout and significance tests of the promotion experiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.distributions import (
    Z_POWER_80_PERCENT,
    Z_TWO_SIDED_5_PERCENT,
    normal_p_value,
    student_p_value,
)
from loomcart.functions.scalar import as_money, ratio
from loomcart.operators.order_values import completed, order_values
from loomcart.sources.star import Star

CONTROL = "control"
TREATMENT = "treatment"


def experiment_orders(star: Star) -> DataFrame:
    return completed(star.orders).where("in_ab_test")


def ab_readout(star: Star) -> DataFrame:
    """Counts, mean order value and revenue by the group stored on the order; non-empty orders only."""
    return (
        order_values(experiment_orders(star), star.lines, few=True)
        .groupBy("ab_test_group")
        .agg(
            F.countDistinct("customer_id").alias("customers_who_ordered"),
            F.count("order_id").alias("total_orders"),
            F.sum("order_value").alias("revenue"),
        )
        .select(
            "ab_test_group",
            "customers_who_ordered",
            "total_orders",
            F.round(ratio(F.col("revenue"), F.col("total_orders")), 2).alias("avg_order_value"),
            as_money(F.col("revenue")).alias("total_revenue"),
        )
    )


def _variance(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance from a count and decimal sums. The difference of the large numbers is taken in decimals, which hold
    10^10 values and sums of 10^16; beyond that in doubles."""
    exact = n.try_cast("decimal(10,0)") * squares.try_cast("decimal(28,4)") - total.try_cast("decimal(18,2)") * total.try_cast("decimal(18,2)")
    doubles = n * squares.cast("double") - total.cast("double") * total.cast("double")
    return ratio(ratio(F.coalesce(exact.cast("double"), doubles), n), n - 1)


def group_moments(star: Star) -> DataFrame:
    """Everything the tests need, one row per customer group.

    Orders are reduced to one row per customer (count, sum, sum of squares, all
    exact) before they meet the customer table. Every customer counts, whether
    or not it ordered; its own group counts, not the one stored on the order.
    """
    value = F.col("order_value")
    per_customer = (
        order_values(experiment_orders(star), star.lines, keep_empty=True, few=True)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.count(value).alias("valued"),
            F.sum(value).alias("spent"),
            F.sum(value * value).alias("squares"),
        )
    )
    spent = F.coalesce(F.col("spent"), F.lit(0))
    return (
        star.customers.select("customer_id", "ab_test_group")
        .join(per_customer, "customer_id", "left")
        .groupBy("ab_test_group")
        .agg(
            F.count("customer_id").alias("customers"),
            F.count_if(F.coalesce(F.col("orders"), F.lit(0)) > 0).alias("converted"),
            ratio(F.sum(spent), F.count("customer_id")).alias("spend_mean"),
            F.var_samp(spent.cast("double")).alias("spend_var"),
            F.coalesce(F.sum("valued"), F.lit(0)).alias("orders"),
            F.sum("spent").alias("order_sum"),
            F.sum("squares").alias("order_squares"),
        )
        .withColumn("order_mean", ratio(F.col("order_sum"), F.col("orders")))
        .withColumn("order_var", _variance(F.col("orders"), F.col("order_sum"), F.col("order_squares")))
        .drop("order_sum", "order_squares")
        .withColumn("rate", ratio(F.col("converted"), F.col("customers")))
    )


def _side_by_side(moments: DataFrame) -> DataFrame:
    """One row with a ``c_`` and a ``t_`` column per moment; groups are picked by name."""
    names = [c for c in moments.columns if c != "ab_test_group"]
    group = F.col("ab_test_group")
    return moments.agg(
        *[F.max(F.when(group == CONTROL, F.col(n))).alias(f"c_{n}") for n in names],
        *[F.max(F.when(group == TREATMENT, F.col(n))).alias(f"t_{n}") for n in names],
    )


def _z() -> Column:
    pooled = (F.col("c_converted") + F.col("t_converted")) / (F.col("c_customers") + F.col("t_customers"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("c_customers") + 1 / F.col("t_customers")))
    return ratio(F.col("t_rate") - F.col("c_rate"), se)


def _welch(mean: str, var: str, n: str) -> tuple[Column, Column]:
    """Statistic (treatment minus control) and Welch-Satterthwaite degrees of freedom."""
    vc = F.col(f"c_{var}") / F.col(f"c_{n}")
    vt = F.col(f"t_{var}") / F.col(f"t_{n}")
    t = ratio(F.col(f"t_{mean}") - F.col(f"c_{mean}"), F.sqrt(vc + vt))
    df = ratio((vc + vt) * (vc + vt), vc * vc / (F.col(f"c_{n}") - 1) + vt * vt / (F.col(f"t_{n}") - 1))
    return t, df


def ab_conversion(star: Star) -> DataFrame:
    """Customers with a completed order in the window over all customers of the group."""
    return group_moments(star).select(
        "ab_test_group", "converted", "customers", F.round("rate", 6).alias("conversion_rate")
    )


def ab_ztest(star: Star) -> DataFrame:
    return _side_by_side(group_moments(star)).select(
        F.round("c_rate", 6).alias("control_rate"),
        F.round("t_rate", 6).alias("treatment_rate"),
        F.round(_z(), 6).alias("z_stat"),
        F.round(normal_p_value(_z()), 6).alias("p_value"),
    )


def _welch_report(star: Star, mean: str, var: str, n: str) -> DataFrame:
    t, df = _welch(mean, var, n)
    return _side_by_side(group_moments(star)).select(
        F.round(f"c_{mean}", 4).alias("control_mean"),
        F.round(f"t_{mean}", 4).alias("treatment_mean"),
        F.round(t, 6).alias("t_stat"),
        F.round(df, 4).alias("degrees_of_freedom"),
        F.round(student_p_value(t, df), 6).alias("p_value"),
    )


def ab_revenue_per_customer(star: Star) -> DataFrame:
    return _welch_report(star, "spend_mean", "spend_var", "customers")


def ab_aov(star: Star) -> DataFrame:
    return _welch_report(star, "order_mean", "order_var", "orders")


def ab_mde(star: Star) -> DataFrame:
    """Smallest absolute lift detectable at 80% power and 5% two-sided, from the control group."""
    p, n = F.col("c_rate"), F.col("c_customers")
    z = Z_TWO_SIDED_5_PERCENT + Z_POWER_80_PERCENT
    return _side_by_side(group_moments(star)).select(
        n.alias("n_per_group"),
        F.round(p, 6).alias("baseline_rate"),
        F.round(z * F.sqrt(2 * p * (1 - p) / n), 6).alias("minimum_detectable_effect"),
    )


def ab_summary(star: Star) -> DataFrame:
    """One row per metric with both groups, the p-value and the 5% verdict."""
    none = F.lit(None).cast("double")

    def metric(name: str, column: str, stat: Column, df: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            F.col(f"c_{column}").alias("control"),
            F.col(f"t_{column}").alias("treatment"),
            stat.alias("stat"),
            df.alias("df"),
        )

    rows = F.array(
        metric("Conversion Rate", "rate", _z(), none),
        metric("Revenue per Customer", "spend_mean", *_welch("spend_mean", "spend_var", "customers")),
        metric("Average Order Value", "order_mean", *_welch("order_mean", "order_var", "orders")),
    )
    tested = _side_by_side(group_moments(star)).select(F.inline(rows))
    p = F.when(F.col("df").isNull(), normal_p_value(F.col("stat"))).otherwise(student_p_value(F.col("stat"), F.col("df")))
    return tested.withColumn("p", p).select(
        "metric",
        F.round("control", 6).alias("control"),
        F.round("treatment", 6).alias("treatment"),
        F.round("p", 6).alias("p_value"),
        (F.col("p") < 0.05).alias("significant_at_0_05"),
    )
