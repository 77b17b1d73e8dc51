"""Calendar dimension: one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_of(bounds: DataFrame) -> DataFrame:
    """``bounds`` has one row (first_day, last_day), both ends included."""
    date = F.col("date")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date")).select(
        "date",
        F.dayofmonth(date).alias("day"),
        F.month(date).alias("month"),
        F.date_format(date, "MMM").alias("month_name"),
        F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
        F.date_format(date, "EEEE").alias("day_of_week"),
        (F.weekday(date) >= 5).alias("is_weekend"),
    )


def calendar_covering(days: DataFrame) -> DataFrame:
    """Calendar from the earliest to the latest ``date`` in ``days``."""
    return calendar_of(days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day")))
