"""Column helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as a double, null where ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent_change(now: Column, before: Column) -> Column:
    """Growth in percent, one decimal; null for a missing or zero base, never -0.0."""
    return F.round(ratio(100.0 * (now - before), before), 1) + F.lit(0.0)


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months between two dates: month boundaries crossed, not elapsed months."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def as_money(total: Column) -> Column:
    """Exact decimal sums leave the library as doubles with two decimals."""
    return F.round(total, 2).cast("double")


def share_between(key: Column, seed: int) -> Column:
    """A number in [0, 2**32) that depends only on ``key`` and ``seed``."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
