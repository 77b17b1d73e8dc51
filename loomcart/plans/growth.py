"""Monthly revenue, growth by row lag and by calendar shift, month-to-date totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.functions.scalar import as_money, month_label, month_start, percent_change, ratio
from loomcart.operators.order_values import completed, gross_values, order_values
from loomcart.sources.star import Star


def monthly_revenue(star: Star) -> DataFrame:
    """Net revenue of completed orders per month."""
    return (
        order_values(completed(star.orders), star.lines)
        .groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(F.round(F.sum("order_value"), 2).alias("revenue"))
    )


def growth_by_lag(monthly: DataFrame) -> DataFrame:
    """Compare with 1 and 12 *rows* back; ``monthly`` has one row per month (month, revenue)."""
    by_month = Window.orderBy("month")  # one row per calendar month: a single task is right
    revenue = F.col("revenue").cast("double")
    rows = monthly.select(
        "month",
        revenue.alias("revenue"),
        F.lag(revenue, 1).over(by_month).alias("prev_month_revenue"),
        F.lag(revenue, 12).over(by_month).alias("revenue_12mo_ago"),
    )
    return rows.select(
        month_label(F.col("month")).alias("month"),
        "revenue",
        "prev_month_revenue",
        percent_change(F.col("revenue"), F.col("prev_month_revenue")).alias("mom_growth_pct"),
        "revenue_12mo_ago",
        percent_change(F.col("revenue"), F.col("revenue_12mo_ago")).alias("yoy_growth_pct"),
    )


def revenue_growth(star: Star) -> DataFrame:
    return growth_by_lag(monthly_revenue(star)).orderBy("month")


def last_of(monthly: DataFrame) -> DataFrame:
    """The last month of a frame with one row per month, with its growth."""
    last = F.max_by(F.struct("month", "revenue", "mom_growth_pct", "yoy_growth_pct"), "month")
    return growth_by_lag(monthly).agg(last.alias("last")).select("last.*")


def latest_month(star: Star) -> DataFrame:
    """The last row of the growth report."""
    return last_of(monthly_revenue(star))


def daily_gross(star: Star) -> DataFrame:
    """List-price revenue of completed orders per day."""
    return (
        completed(star.orders)
        .join(gross_values(star.order_items), "order_id")
        .groupBy(F.col("order_date").alias("date"))
        .agg(F.sum("gross_value").alias("completed_revenue"))
    )


def growth_by_calendar(monthly: DataFrame) -> DataFrame:
    """Compare with 1 and 12 *calendar* months earlier; ``monthly`` has (month, revenue).

    A month without revenue leaves its successor without a base, where a row lag
    would silently use an older month. Every month also reports itself forward as
    the base of the months it precedes: a self-join in one pass over its input.
    """

    def forward(months: int) -> Column:
        return F.struct(F.add_months("month", months).alias("month"), F.lit(months).alias("shift"), "revenue")

    def base(months: int) -> Column:
        return F.max(F.when(F.col("shift") == months, F.col("revenue")))

    now, prior, last_year = F.col("revenue"), F.col("revenue_prior_month"), F.col("revenue_same_month_last_year")
    return (
        monthly.select(F.inline(F.array(forward(0), forward(1), forward(12))))
        .groupBy("month")
        .agg(
            F.count_if(F.col("shift") == 0).alias("present"),
            base(0).alias("revenue"),
            base(1).alias("revenue_prior_month"),
            base(12).alias("revenue_same_month_last_year"),
        )
        .where("present > 0")
        .select(
            month_label(F.col("month")).alias("month"),
            now.cast("double").alias("completed_revenue"),
            prior.cast("double").alias("revenue_prior_month"),
            F.round(ratio(now - prior, prior), 6).alias("mom_growth"),
            last_year.cast("double").alias("revenue_same_month_last_year"),
            F.round(ratio(now - last_year, last_year), 6).alias("yoy_growth"),
        )
    )


def calendar_growth(star: Star) -> DataFrame:
    monthly = (
        daily_gross(star)
        .groupBy(month_start(F.col("date")).alias("month"))
        .agg(F.sum("completed_revenue").alias("revenue"))
    )
    return growth_by_calendar(monthly).orderBy("month")


def revenue_mtd(star: Star) -> DataFrame:
    """Running completed revenue within the month, for every calendar day."""
    so_far = (
        Window.partitionBy(month_start(F.col("date"))).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    )
    daily = star.dates.select("date").join(daily_gross(star), "date", "left")
    amount = F.coalesce(F.col("completed_revenue"), F.lit(0).cast("decimal(38,2)"))
    return daily.select(
        "date",
        as_money(amount).alias("completed_revenue"),
        as_money(F.sum(amount).over(so_far)).alias("revenue_mtd"),
    )
