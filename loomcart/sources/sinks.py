"""Result and metric sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def metrics_frame(spark: SparkSession, model: str, metrics: dict[str, float]) -> DataFrame:
    """One row per metric: (model, metric, value)."""
    rows = [(model, name, float(value)) for name, value in metrics.items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def write_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
