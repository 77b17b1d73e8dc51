"""Monthly revenue kept up to date: a batch replaces the months it touches, and loading it twice changes nothing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.functions.scalar import month_start
from loomcart.session import discard, materialise

ORDERS = "order_id long, order_value decimal(38,2), version long, month date"
MONTHS = "revenue decimal(38,2), orders long, month date"


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _replace(df: DataFrame, folder: str) -> None:
    """Overwrites the months that ``df`` has, and no other."""
    df.repartition("month").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("month").parquet(folder)


def load_batch(values: DataFrame, folder: str, version: int) -> None:
    """Brings ``values`` (``order_id, order_date, order_value``) into the roll-up under ``folder``.

    The rows of an order's highest version count; a batch loaded again has the same version and replaces itself. An order
    that moves to another month leaves the one it was in. Only the months of the batch and of its orders' earlier versions
    are read and written, each first to the orders, then to the totals; a load that broke off is made good by loading the
    batch again.
    """
    spark = values.sparkSession
    batch = materialise(
        values.select(
            "order_id", F.col("order_value").cast("decimal(38,2)").alias("order_value"), F.lit(version).cast("long").alias("version"),
            month_start(F.col("order_date")).alias("month"),
        ),
        "rollup-batch",
    )
    stored = _read(spark, f"{folder}/orders", ORDERS).where("version >= 0")
    earlier = stored.join(batch.select("order_id"), "order_id", "left_semi").select("month")
    touched = materialise(batch.select("month").union(earlier).distinct(), "rollup-months")
    days = [r["month"] for r in touched.collect()]  # months, a few hundred at most
    present = stored.where(F.col("month").isin(days))
    # A key's rows: those of one version, so that a repeated order id of a batch keeps all its rows.
    newer = batch.groupBy("order_id").agg(F.max("version").alias("_new"))
    kept = present.join(newer, "order_id", "left").where(F.col("_new").isNull() | (F.col("version") > F.col("_new"))).drop("_new")
    known = present.groupBy("order_id").agg(F.max("version").alias("_old"))
    fresh = batch.join(known, "order_id", "left").where(F.col("_old").isNull() | (F.col("version") >= F.col("_old"))).drop("_old")
    orders = materialise(kept.unionByName(fresh), "rollup-orders")
    totals = orders.groupBy("month").agg(F.sum("order_value").cast("decimal(38,2)").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    emptied = touched.join(orders.select("month").distinct(), "month", "left_anti")
    _replace(orders, f"{folder}/orders")
    _replace(materialise(totals, "rollup-totals"), f"{folder}/months")
    gone = [r["month"] for r in emptied.collect()]
    if gone:  # dynamic overwrite leaves months that have no row any more: an empty total takes their place
        blank = spark.createDataFrame([(None, 0, m) for m in gone], MONTHS)
        _replace(blank, f"{folder}/months")
        _replace(spark.createDataFrame([(None, None, -1, m) for m in gone], ORDERS), f"{folder}/orders")
    for df in (batch, touched, orders):
        discard(df)


def monthly_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``month, revenue`` of the months that have orders."""
    return _read(spark, f"{folder}/months", MONTHS).where("orders > 0").select("month", F.round("revenue", 2).alias("revenue"))
