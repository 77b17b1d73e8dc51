"""Feature vectors for the models: numbers as they are, categories one-hot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Encoder:
    """Median of every number, for its missing values, and the levels that get a column."""

    medians: dict[str, float]
    levels: dict[str, list[str]]

    def names(self) -> list[str]:
        return [*self.medians, *[f"{c}_is_{level}" for c, levels in self.levels.items() for level in levels]]

    def one_hot(self, df: DataFrame) -> DataFrame:
        """Columns named as ``names``. A null category is 0 in all its columns, as is an unknown one."""
        numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.medians.items()}
        flags = {
            f"{c}_is_{level}": F.coalesce(F.col(c) == F.lit(level), F.lit(False)).cast("double")
            for c, levels in self.levels.items()
            for level in levels
        }
        return df.select("*", *[v.alias(f"_x{i}") for i, v in enumerate({**numbers, **flags}.values())])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features``."""
        columns = [f"_x{i}" for i in range(len(self.names()))]
        return VectorAssembler(inputCols=columns, outputCol="features").transform(self.one_hot(df)).drop(*columns)


def fit_encoder(df: DataFrame, numbers: list[str], categories: list[str]) -> Encoder:
    """Of every category the alphabetically first level has no column; null is no level.

    The driver gets one row: a median for each number and the levels of each category, of which there must be few.
    """
    row = df.agg(
        *[F.percentile(F.col(c).cast("double"), 0.5).alias(f"n_{c}") for c in numbers],
        *[F.array_sort(F.collect_set(c)).alias(f"c_{c}") for c in categories],
    ).first()
    medians = {c: 0.0 if row[f"n_{c}"] is None else float(row[f"n_{c}"]) for c in numbers}
    return Encoder(medians, {c: row[f"c_{c}"][1:] for c in categories})
