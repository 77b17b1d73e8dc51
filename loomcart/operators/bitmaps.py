"""Distinct customers as bitmaps: exact counts under any later grouping, without the customers themselves.

A bitmap has a bit for each of 32,768 consecutive ids; a row holds one group's bitmap of one range of ids. Rows of groups
that are put together later are merged with OR, those that must hold at once with AND, and bits are counted last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """``by``, ``bucket`` and ``ids``: which values of the integer ``key`` occur. Null keys are not counted.

    Bits are set before the shuffle, so a value that fills a third of the rows is one bit of each task's bitmap. A bitmap
    is 4 KB whatever it holds; keys should be dense.
    """
    placed = rows.where(F.col(key).isNotNull()).select(
        *by, F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("_bit")
    )
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("ids"))


def merged(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def distinct_count(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many keys each group of ``by`` has; the groups of ``maps`` may be finer."""
    return merged(maps, by).groupBy(*by).agg(counted().alias(name))


def counted() -> Column:
    """Bits of one group's merged rows, one for each bucket."""
    return F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0))
